"""Toxicity and language identification: held-out accuracy, exact code lengths, hard rows."""

import math
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import langid, toxicity

from .helpers import HARD, clashing, documents

BAD = [stem + end for stem in ("groll", "snarf") for end in ("", "ing", "ed", "er", "ish", "ly")]
SYLLABLES = {
    "aa": ["ba", "do", "ki", "lu", "me", "ro", "sa", "te"],
    "bb": ["sch", "ung", "eit", "ver", "zu", "ä", "ger", "ich"],
}


def _text(rng, lang="aa", n=60):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 3))) for _ in range(n)) + "."


def _toxic(rng, words, **options):
    text = _text(rng, **options).split(" ")
    for _ in range(rng.randint(1, 3)):
        text.insert(rng.randrange(len(text)), rng.choice(words))
    return " ".join(text)


@pytest.fixture(scope="module")
def model():
    rng = random.Random(5)
    labels = [i % 3 == 0 for i in range(600)]
    texts = [_toxic(rng, BAD[:5] + BAD[6:11]) if label else _text(rng) for label in labels]
    return toxicity.train(texts, [int(label) for label in labels])


def test_held_out_texts(model):
    rng, scorer = random.Random(6), toxicity.Scorer(model)
    clean = scorer.scores([_text(rng, n=rng.choice((5, 60, 900))) for _ in range(200)])
    bad = scorer.scores([_toxic(rng, BAD[:5], n=rng.choice((5, 60, 900))) for _ in range(200)])
    errors = sum(s >= 0.5 for s in clean) + sum(s < 0.5 for s in bad)
    assert errors <= 0.05 * 400
    unseen = scorer.scores([_toxic(rng, ["grolly", "snarfly", "grollled"]) for _ in range(50)])
    assert sum(s >= 0.5 for s in unseen) >= 40


def test_one_class_or_none():
    assert toxicity.Scorer(toxicity.train([], [])).scores(["x"])[0] < 0.5
    assert toxicity.Scorer(toxicity.train(["a b"], [1])).scores([""])[0] > 0.5


def _brute_score(model, text):
    """The worst passage's mean over words of the mean weight of their n-grams."""
    words = toxicity.words_of(text)
    means = []
    for word in words:
        marked = b"<" + word + b">"
        grams = [marked] + [
            marked[i : i + k] for k in range(3, 7) for i in range(len(marked) - k + 1)
        ]
        means.append(sum(float(model.weights[zlib.crc32(g) % toxicity.BUCKETS]) for g in grams) / len(grams))
    count = max(1, len(words) // toxicity.PASSAGE)
    starts = [i * len(words) // count for i in range(count)] + [len(words)]
    passages = [means[i:j] for i, j in zip(starts, starts[1:])]
    worst = max((sum(p) / len(p) for p in passages if p), default=0.0)
    return 1 / (1 + math.exp(-(model.bias + worst)))


def test_scores_are_those_of_the_formula(model):
    rng = random.Random(11)
    texts = [_toxic(rng, BAD, n=rng.randint(1, 80)) for _ in range(60)] + ["", "a", "é 漢字の x", "<>"]
    scorer = toxicity.Scorer(model, cached=20)
    for _ in range(2):  # known and forgotten words alike
        for text, score in zip(texts, scorer.scores(texts)):
            assert abs(score - _brute_score(model, text)) < 1e-6


def test_every_ngram_of_long_runs_is_read():
    rng = random.Random(9)
    for n in (41, 45, 46, 60, 61, 64, 65, 66, 300, 1_001):
        run = "".join(rng.choices("abcdefghij漢字の", k=n))
        read = set(toxicity.subwords(toxicity.words_of(run))[0].tolist())
        raw = run.encode()
        grams = (raw[i : i + k] for k in range(3, 7) for i in range(len(raw) - k + 1))
        assert all(zlib.crc32(gram) % toxicity.BUCKETS in read for gram in grams)
        assert max(map(len, toxicity.words_of(run))) <= toxicity.WORD
    for space in "\u00a0\u200b\u3000。、—":
        assert toxicity.words_of(space.join(["one", "two"] * 20)) == [b"one", b"two"] * 20


def test_toxic_words_in_text_without_spaces():
    rng = random.Random(10)
    letters = [chr(0x4E00 + i) for i in range(2_000)]
    bad = ["".join(rng.choices(letters, k=4)) for _ in range(3)]

    def text(toxic):
        found = rng.choices(letters, k=rng.randint(60, 300))
        if toxic:
            found.insert(rng.randint(20, len(found) - 20), rng.choice(bad))
        return "".join(found)

    labels = [int(i % 3 == 0) for i in range(1_200)]
    scorer = toxicity.Scorer(toxicity.train([text(label) for label in labels], labels))
    wrong = sum(
        (score >= 0.5) != label
        for label in (0, 1)
        for score in scorer.scores([text(label) for _ in range(100)])
    )
    assert wrong <= 0.05 * 200


def test_toxicity_of_hard_rows(spark, model):
    docs = clashing(documents(spark))
    rows = toxicity.score_documents(docs, model).collect()
    assert [r.doc_id for r in rows] == [r[0] for r in HARD]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert toxicity.drop_toxic(docs, model).columns == docs.columns
    assert toxicity.score_documents(documents(spark, []), model).count() == 0
    labels = spark.createDataFrame(
        [(5, 0), (5, 1), (4, 0), (None, 1), (9, 1), (6, None)], "doc_id long, toxic int"
    )
    toxicity.fit(docs, labels)
    toxicity.fit(documents(spark, []), labels.where("false"))


def _brute_bits(words, counted):
    """Code length of words by walking the contexts of one language."""
    seen = Counter()
    for word, n in counted.items():
        marked = b" " + word
        for i in range(1, len(marked)):
            for order in range(min(i, langid.ORDER) + 1):
                seen[marked[i - order : i], marked[i]] += n
    nodes = {}
    for (context, byte), n in seen.items():
        nodes.setdefault(context, {})[byte] = n
    total = 0.0
    for word in words:
        marked = b" " + word
        for i in range(1, len(marked)):
            for order in range(min(i, langid.ORDER), -1, -1):
                node = nodes.get(marked[i - order : i])
                if node is None:
                    continue
                n, kinds = sum(node.values()), len(node)
                if marked[i] in node:
                    total -= math.log2(node[marked[i]] / (n + kinds))
                    break
                total -= math.log2(kinds / (n + kinds))
            else:
                total += 8
    return total


def test_code_lengths_are_exact():
    rng = random.Random(7)
    counted = {lang: Counter(langid.words_of(_text(rng, lang, 40))) for lang in SYLLABLES}
    model = langid.build({lang: langid.count_runs(words) for lang, words in counted.items()})
    scorer = langid.Scorer(model, cached=50)
    for text in [_text(rng, lang, 30) for lang in SYLLABLES] + ["zzz \x00 漢字 äöü ba", "q"]:
        bits, n = scorer.bits(text)
        words = langid.words_of(text)
        assert n == sum(map(len, words))
        for i, lang in enumerate(model.languages):
            assert abs(bits[i] - _brute_bits(words, counted[lang])) < 1e-3 * max(1, bits[i])


def test_languages(spark):
    rng = random.Random(8)
    rows = [(i, _text(rng, "ab"[i % 2] * 2), "ab"[i % 2] * 2, "s", 1) for i in range(80)]
    docs = documents(spark, rows)
    model = langid.fit(docs, F.col("doc_id") < 60, rows=20)
    assert model.languages == ["aa", "bb"]
    found = langid.identify(docs.where("doc_id >= 60"), model).collect()
    assert [r.lang_pred for r in found] == ["aa", "bb"] * 10 and all(r.score > 0.9 for r in found)
    hard = clashing(documents(spark))
    rows = langid.identify(hard, model).collect()
    assert [r.lang_pred == "und" for r in rows][:3] == [True] * 3
    assert all(0 <= r.score <= 1 for r in rows)
    kept = langid.drop_unidentified(docs, model)
    assert kept.columns == docs.columns and kept.count() == 80
    assert langid.drop_unidentified(documents(spark, [(1, "12.34", "aa", "s", 1), (2, None, None, None, 1)]), model).count() == 0


def test_letters_are_those_of_unicode():
    for text in ("12 ½ ² !!", "Ⅷ ①", "_", "", "١٢"):
        assert not langid.has_letter(text)
    for text in ("a", "1 é", "漢", "ª"):
        assert langid.has_letter(text)


def test_sample_of_many_rows_in_one_language(spark):
    rows = [(i, f"text {i}", "aa" if i % 50 else "bb", "s", 1) for i in range(4_000)]
    rows += [(None, "same", "aa", "s", 1)] * 500
    docs = documents(spark, rows)
    sample = langid.training_sample(docs, rows=20).collect()
    assert Counter(r.lang for r in sample) == {"aa": 20, "bb": 20}
    assert len(set(sample)) == 40
    assert sorted(langid.training_sample(docs.repartition(7), rows=20).collect()) == sorted(sample)
    few = langid.training_sample(docs.limit(0).union(documents(spark, rows[:60])), rows=100).collect()
    assert Counter(r.lang for r in few) == {"aa": 58, "bb": 2}


def test_no_language_to_learn(spark):
    model = langid.fit(documents(spark, []))
    assert [r.lang_pred for r in langid.identify(documents(spark), model).collect()] == ["und"] * len(HARD)
    assert langid.drop_unidentified(documents(spark), model).count() == 6
