"""Deterministic stand-ins for the chat model, for tests and the driver checks.

These are test doubles, not models: they let the model job, reply routing
and parsing run end to end without an endpoint.  Their output is a pure
function of the request, so an SQL twin can predict it.
"""

from __future__ import annotations

import base64
import hashlib
import json


def echo_trait_client_factory():
    """Client that answers a text request with traits read off the product name.

    ``category1`` = last word, ``color`` = first word, ``style`` = the whole
    name, ``occasion`` = ``unknown``; names starting with ``hot`` raise, to
    exercise per-row error capture.
    """

    def client(request_json: str) -> str:
        req = json.loads(request_json)
        question = req["messages"][-1]["content"][0]["text"]
        name = question[question.index('"') + 1 : question.rindex('"')]
        words = name.split(" ")
        if words[0] == "hot":
            raise RuntimeError("endpoint refused the request")
        obj = {"category1": words[-1], "color": words[0], "style": name, "occasion": "unknown"}
        return "Traits follow.\n[" + json.dumps(obj, ensure_ascii=False) + "]"

    return client


def picture_trait_client_factory():
    """Client that answers an image request with traits of the picture's bytes.

    ``category1`` = 12 digits of their MD5, ``color`` = their number, ``occasion`` = ``unknown``; a number that 13 divides
    raises, to exercise per-row error capture.
    """

    def client(request_json: str) -> str:
        url = json.loads(request_json)["messages"][-1]["content"][1]["image_url"]["url"]
        picture = base64.b64decode(url.partition(",")[2])
        if len(picture) % 13 == 0:
            raise RuntimeError("endpoint refused the picture")
        return json.dumps({"category1": hashlib.md5(picture).hexdigest()[:12], "color": str(len(picture)), "occasion": "unknown"})

    return client


LETTERS = "abcdefghijklmnopqrstuvwxyz"


def letter_encoder_factory():
    """Deterministic encoder double: the text's length, then how often it has each letter."""

    def encode(texts):
        return [[float(len(t)), *(float(t.lower().count(c)) for c in LETTERS)] for t in texts]

    return encode
