"""Fixed values.

Everything in this module must keep exactly these values for results to agree
with the original pipeline's data contract (tags, JSON keys, templates, the
catalog dictionary, the missing-value tokens).  They are stated plainly and in
their natural order; change them only together with the data they describe.
"""

from __future__ import annotations

# --- fixed values: entity tags -------------------------------------------------
TAG_NAME = "product_name"
TAG_IMAGE = "product_image"
TAG_TEXT = "product_text"
TAGS = (TAG_NAME, TAG_IMAGE, TAG_TEXT)

# --- fixed values: trait keys of one model-reply JSON object, in table order ----
TRAIT_KEYS = ("category1", "category2", "color", "style", "material", "occasion")

# Placeholder the model uses for an attribute it is unsure about.
UNKNOWN = "unknown"

# Trait keys that enter the text/image documents that get embedded (color and
# material are deliberately left out), in concatenation order.
DOCUMENT_TRAIT_KEYS = ("category1", "category2", "style", "occasion")

# --- fixed values: request / prompt templates -----------------------------------
TEXT_QUESTION_PREFIX = 'What can you tell me about "'
TEXT_QUESTION_SUFFIX = '" ?'
IMAGE_QUESTION = "What can you tell me about this image?"
DATA_URL_PREFIX = "data:image/jpeg;base64,"
ENCODER_PROMPT_FORMAT = "Instruct: %s\nQuery: %s"
DEFAULT_ENCODER_INSTRUCT = "Compare product descriptions"  # a setting; users pass their own
DEFAULT_TEMPERATURE = 0.0

# --- fixed values: tokens read as missing by the catalog CSV scan ---------------
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# --- fixed values: characters stripped from the scraped numbers -----------------
REVIEW_STRIP_CHARS = "()"
PRICE_STRIP_CHARS = "원,"

# --- fixed values: scraped CSV header -> catalog column -------------------------
CATALOG_RENAMES = {
    "web-scraper-order": "prd_id",
    "image-src": "prd_img",
    "image2-src": "delivery_type",
    "rating": "review",
    "ratingValue": "review_rating",
    "price3": "price",
    "name": "prd_name",
}
CATEGORY_LINK_COLUMN = "category-link-0-href"

# --- fixed values: default category dictionary (category link -> name) ---------
DEFAULT_CATEGORY_MAP = {
    "https://www.coupang.com/np/categories/498918?channel=plp_C2": "티셔츠",
    "https://www.coupang.com/np/categories/498919?channel=plp_C2": "맨투맨/후디",
    "https://www.coupang.com/np/categories/498922?channel=plp_C2": "셔츠",
    "https://www.coupang.com/np/categories/498930?channel=plp_C2": "니트/조끼",
    "https://www.coupang.com/np/categories/498934?channel=plp_C2": "아우터",
    "https://www.coupang.com/np/categories/498929?channel=plp_C2": "후드집업/집업",
    "https://www.coupang.com/np/categories/498924?channel=plp_C2": "바지",
    "https://www.coupang.com/np/categories/498923?channel=plp_C2": "정장/세트",
    "https://www.coupang.com/np/categories/498928?channel=plp_C2": "트레이닝복",
    "https://www.coupang.com/np/categories/565081?channel=plp_C2": "속옷/잠옷",
    "https://www.coupang.com/np/categories/498938?channel=plp_C2": "비치웨어",
    "https://www.coupang.com/np/categories/498940?channel=plp_C2": "테마의류",
    "https://www.coupang.com/np/categories/498943?channel=plp_C2": "커플/패밀리룩",
    "https://www.coupang.com/np/categories/498946?channel=plp_C2": "스포츠의류",
    "https://www.coupang.com/np/categories/498939?channel=plp_C2": "한복/수의",
    "https://www.coupang.com/np/categories/498974?channel=plp_C2": "신발",
    "https://www.coupang.com/np/categories/499007?channel=plp_C2": "가방/잡화",
}
