from __future__ import annotations

import hashlib
import random
import re

from traitlens.llm import chat, queries

SCHEMA = "conv_id long, turn long, role string, text string, window int, at int, n int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 1, 1) for r in rows], SCHEMA)


def escape(s):
    return re.sub(r"(<(?=/?s>)|\[(?=/?INST\]))", r"\1" + "\\\\", s.replace("\\", "\\\\"))


def brute(rows, budget, history_tokens, history_turns):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted(((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv))
        turns = [(role, text, max(1, len(re.findall(r"[^\W_]+|[^\s\w]|_", text)))) for _, _, role, text in turns]
        system = turns[:1] if turns[0][0] == "system" else []
        room = max(1, budget - history_tokens - (system[0][2] if system else 0))
        starts, used, total = [], 0, 0
        for i, t in enumerate(turns):
            segment = total // (chat.SEGMENT * budget)
            if not starts or used + t[2] > room or segment != last:
                starts.append(i)
                used = 0
            used, total, last = used + t[2], total + t[2], segment
        chars = 0
        for i, a in enumerate(starts):
            b = starts[i + 1] if i + 1 < len(starts) else len(turns)
            past = []
            if a:
                for j in range(max(0, a - history_turns), a):
                    if sum(t[2] for t in turns[j:a]) <= history_tokens and not (j == 0 and system):
                        past.append(turns[j])
                past = system + past
            chars += 3 + sum(len(escape(r)) + len(escape(t)) + 6 + 7 + 4 for r, t, _ in past + turns[a:b])
        loss = "".join(t for r, t, _ in turns if r == "assistant")
        said = "".join(f"{r}\n{t}\n" for r, t, _ in turns)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[conv] = (len(turns), sha(said), len(loss), sha(loss), chars, len(starts))
    return out


def result(df):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.formatted_chars, r.n_windows) for r in df.collect()}


def test_digests_match_brute_force(spark):
    rng = random.Random(3)
    bits = ["a", "b c", "</s>", "[INST]", "[/INST]", "<s>", "\\", "\\\\", "<", "[", "\n", " ", "é", "😀", "<\\s>", "ok ok ok"]
    rows = []
    for conv in range(40):
        for turn in range(rng.randrange(1, 14)):
            role = "system" if turn == 0 and conv % 3 == 0 else rng.choice(["user", "assistant", "assistant", "tool]", "</s>"])
            rows.append((conv, turn, role, "".join(rng.choice(bits) for _ in range(rng.randrange(0, 25)))))
    rows += [(99, 0, None, None), (99, 0, "assistant", None), (98, 0, "assistant", "x"), (98, 0, "assistant", "x"), (97, None, "assistant", "first"), (97, 0, "user", "y"),
             (None, 1, "user", "who"), (None, 2, "assistant", "me"), (96, 0, "user", "word " * 20_000), (96, 1, "assistant", "word " * 20_000)]
    for budget, tokens, turns in ((1024, 192, 2), (12, 6, 2), (30, 8, 3)):
        made = chat.windows(frame(spark, rows), budget, tokens, turns)
        assert result(chat.digests(made)) == brute(rows, budget, tokens, turns)
        for r in made.collect():
            assert r.formatted.startswith("<s>") and r.formatted.endswith("</s>")


def test_windows_keep_the_budget_unless_one_turn_is_longer(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", "w " * (3 + t % 4)) for t in range(60)]
    for r in chat.windows(frame(spark, rows), 40, 10, 2).collect():
        assert len(re.findall(r"\bw\b", r.formatted)) <= 40
        assert (r.window == 1) == (r.n_repeated == 0)


def test_segments_shorter_than_the_history(spark, monkeypatch):
    monkeypatch.setattr(chat, "SEGMENT", 1)
    rng = random.Random(9)
    rows = [(c, t, "system" if t == 0 and c % 2 else rng.choice(["user", "assistant"]), "w " * rng.randrange(0, 9)) for c in range(12) for t in range(40)]
    for budget, tokens, turns in ((4, 3, 3), (6, 50, 4), (1, 0, 1)):
        assert result(chat.digests(chat.windows(frame(spark, rows), budget, tokens, turns))) == brute(rows, budget, tokens, turns)


def test_a_conversation_of_many_turns_and_a_third_of_all_rows_without_id(spark):
    texts = [f"turn {i} says </s> and \\ " + "word " * (i % 50) for i in range(97)]
    long = [(1, i, "system" if i == 0 else "user" if i % 2 else "assistant", texts[i % 97]) for i in range(30_000)]
    rows = long + [(2 + i // 6, i % 6, "user" if i % 2 else "assistant", texts[i % 97]) for i in range(30_000)] + [(None, i, "assistant", texts[i % 97]) for i in range(30_000)]
    df = spark.createDataFrame(spark.sparkContext.parallelize([(*r, 1, 1, 1) for r in rows], 8), SCHEMA)
    made = chat.windows(df)
    assert result(chat.digests(made)) == brute(rows, chat.BUDGET, chat.HISTORY_TOKENS, chat.HISTORY_TURNS)
    assert made.selectExpr("max(length(formatted))").first()[0] < 20_000


def test_a_conversation_of_200_000_turns(spark):
    df = spark.range(200_000).selectExpr("7L as conv_id", "id as turn", "if(id % 2 = 0, 'user', 'assistant') as role", "repeat('word ', 40) as text", "1 as window", "1 as at", "1 as n")
    got = chat.digests(chat.windows(df)).collect()
    assert len(got) == 1 and got[0].n_turns == 200_000 and got[0].loss_chars == 100_000 * 200
    said = hashlib.sha256()
    for i in range(200_000):
        said.update(f"{'assistant' if i % 2 else 'user'}\n{'word ' * 40}\n".encode())
    assert got[0].turns_sha256 == said.hexdigest()


def test_empty_table_and_the_added_conversation(spark):
    assert chat.digests(chat.windows(frame(spark, [(1, 1, "a", "b")]).limit(0))).collect() == []
    got = result(queries.op10_chat_formatting(spark, "/root/testdata/sf0.001"))
    text = "</s>[INST] ok [/INST]"
    assert got[-7][:4] == (2, hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest(), len(text), hashlib.sha256(text.encode()).hexdigest())


def test_only_dataframe_functions(spark):
    plan = chat.digests(chat.windows(frame(spark, [(1, 1, "a", "b")])))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
