"""Licence scans: base phrases by brute force, matching statistics, template spans."""

import random
import re

from tidemark.llm import licenses

from .helpers import HARD, clashing, documents, fuzz

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SMALL = {code: code + 32 for code in range(65, 91)}


def _base(text):
    words = WORD.findall(text.translate(SMALL))
    places = []
    for label, phrase in licenses.BASE_PHRASES:
        want = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(want)] == want]
    return len(words), sorted(places)


def test_base_phrases():
    rng = random.Random(2)
    words = "under the mit license apache version 2 cc by nc BY-NC x Über General".split()
    texts = [" ".join(rng.choice(words) for _ in range(60)) for _ in range(2_000)] + fuzz(1_000)
    texts += [f"a {phrase} b {phrase}" for _, phrase in licenses.BASE_PHRASES]
    scanner = licenses.Scanner()
    for text in texts:
        assert scanner.scan(text)[:2] == _base(text)


def test_the_automaton_holds_all_runs_and_their_places():
    rng = random.Random(3)
    for _ in range(30):
        sequences = [[rng.randint(1, 3) for _ in range(rng.randint(1, 12))] for _ in range(3)]
        automaton = licenses.SuffixAutomaton()
        for sequence in sequences:
            automaton.add(sequence)
        automaton.close()
        for n, sequence in enumerate(sequences):
            for i in range(len(sequence)):
                for j in range(i + 1, len(sequence) + 1):
                    run = sequence[i:j]
                    ends = {
                        (m, k + len(run) - 1)
                        for m, other in enumerate(sequences)
                        for k in range(len(other))
                        if other[k : k + len(run)] == run
                    }
                    assert automaton.ends[automaton.find(run)] == ends and (n, j - 1) in ends


def _labels(text):
    return [span.label for span in licenses.scanner().scan(text)[2]]


def test_template_spans():
    assert _labels("x This work is licensed under the GNU General Public License, version 3. y") == ["gpl-3"]
    assert _labels("licensed under the GNU Lesser General Public License version 3") == ["lgpl-3"]
    assert _labels("Licensed under CC BY-SA 4.0. Licensed under CC BY 4.0.") == ["cc-by-sa", "cc-by"]
    whole = next(text for label, text in licenses.TEMPLATES if label == "bsd")
    words = whole.split()
    changed = " ".join([*words[:10], "some", "new", *words[10:]])
    [span] = licenses.scanner().scan("before " + changed + " after")[2]
    assert (span.label, span.first_word) == ("bsd", 1) and 0.8 <= span.coverage <= 1
    assert _labels(" ".join(words[: len(words) // 2])) == []
    assert _labels("the software is under a license of its own and the rest is free") == []


def test_hard_rows(spark):
    rows = [*HARD, (8, "Released under the MIT License. " * 2_000, None, None, None)]
    scanned = licenses.digest(licenses.scan_licenses(clashing(documents(spark, rows)))).collect()
    for (doc, text, *_), row in zip(rows, scanned):
        n, places = _base(text or "")
        firsts = [i for i, _ in places]
        assert (row.doc_id, row.n_words, row.n_base) == (doc, n, len(places))
        assert row.first_word == (min(firsts) if firsts else None)
        assert row.last_word == (max(firsts) if firsts else None)
        assert row.base_labels == ",".join(sorted({x for _, x in places})) and 0 <= row.score <= 1
        assert set(filter(None, row.base_labels.split(","))) <= set(row.labels.split(","))
    assert scanned[-1].labels == "mit" and scanned[0].labels == "" and scanned[0].score == 0
    assert licenses.digest(licenses.scan_licenses(documents(spark, []))).count() == 0


def _small_scanner(rng):
    words = "abcde"
    templates = [(f"t{i}", " ".join(rng.choices(words, k=rng.randint(6, 14)))) for i in range(3)]
    base = [("base", "a b a")]
    return licenses.Scanner(base, templates), words, [text for _, text in [*templates, *base]]


def test_matching_statistics_are_the_longest_matches():
    """At each place the longest run of any template that ends there; kept where none goes on."""
    rng = random.Random(5)
    for _ in range(60):
        scanner, words, texts = _small_scanner(rng)
        held = [[scanner.ids[w] for w in licenses.words_of(text)] for text in texts]
        runs = {tuple(h[i:j]) for h in held for i in range(len(h)) for j in range(i + 1, len(h) + 1)}
        ids = [scanner.ids[w.encode()] for w in rng.choices([w for w in words if w.encode() in scanner.ids], k=40)]
        longest = [
            max((n for n in range(end + 1) if tuple(ids[end - n : end]) in runs), default=0)
            for end in range(len(ids) + 1)
        ]
        want = [
            (end, longest[end])
            for end in range(1, len(ids) + 1)
            if longest[end] >= licenses.MIN_MATCH
            and (end == len(ids) or longest[end + 1] != longest[end] + 1)
        ]
        matches = []
        scanner._stream(ids, 0, matches, [])
        assert [(end, length) for end, length, _ in matches] == want


def test_chains_cover_as_much_as_any():
    rng = random.Random(8)
    for _ in range(40):
        scanner, words, _ = _small_scanner(rng)
        text = " ".join(rng.choices(words + "q", weights=[4] * 5 + [1], k=60))
        ids = [scanner.ids.get(w.encode(), 0) for w in text.split()]
        matches = []
        stretch = []
        for at, word in enumerate([*ids, 0]):
            if word:
                stretch.append(word)
            elif stretch:
                scanner._stream(stretch, at - len(stretch), matches, [])
                stretch = []
        best = 0.0
        for template, size in enumerate(scanner.sizes):
            pieces = sorted(
                (end - n, last + 1 - n, n)
                for end, n, state in matches
                for t, last in scanner.ends[state]
                if t == template
            )

            def longest(i):
                start, place, n = pieces[i]
                before = [
                    longest(j)
                    for j, (s, p, m) in enumerate(pieces[:i])
                    if s + m <= start <= s + m + licenses.MAX_GAP and p + m <= place
                ]
                return n + max(before, default=0)

            best = max([best, *(longest(i) / size for i in range(len(pieces)))])
        spans = scanner._spans(matches) if matches else []
        found = max((span.coverage for span in spans), default=0.0)
        assert found == (best if best >= licenses.MIN_COVERAGE else 0.0)
