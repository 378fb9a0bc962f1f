"""Documents that every text operator must take."""

import random

LETTERS = list("abcdstrevm  \n\t\r.,'\"!?0129éàßñèAÜ 　’́漢🙂<|>_²▁") + [
    "<|endoftext|>", "<|startoftext|>", "'s", "'re", "the ", " under the MIT License", "  ",
]


def fuzz(n, seed=1, longest=40):
    rng = random.Random(seed)
    return ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, longest))) for _ in range(n)]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Ids, null and empty texts, a very long text, repeated rows, and a row without id.
HARD = [
    (1, None, None, None, None),
    (2, "", "en", "s", 0),
    (3, " \n\t ", None, "s", 4),
    (4, "word " * 30_000, "en", "s", None),
    (5, "same text, twice. 12.34.56.78", "en", "s", 1),
    (5, "same text, twice. 12.34.56.78", "en", "s", 1),
    (6, "x", None, None, 1),
    (None, "a row without id but with words", "en", "s", 1),
    (7, "Ünïcödé 漢字 🙂 \x00 <|endoftext|> ▁ a@b.example", "de", "s", 9),
]
#: Names that operators use for their own columns.
CLASHES = ("n_tokens", "score", "kept", "text_key", "row", "shard", "band", "class_id", "version")


def documents(spark, rows=HARD):
    return spark.createDataFrame(rows, SCHEMA)


def clashing(docs):
    from pyspark.sql import functions as F

    return docs.withColumns({name: F.lit("other") for name in CLASHES})
