from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from review_signals.llm import spelling_variants
from review_signals.llm.spelling_variants import Variants, group_variants

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(pairs, variants):
    counts = Counter()
    for i, text in pairs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % variants.worn == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= variants.min_length and n >= variants.min_count}


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def brute_force(pairs, variants=Variants()):
    words = counted(pairs, variants)
    near = {w: [v for v in words if one_apart(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= variants.times * words[w] else None
    result = {}
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        result[w] = (form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None)
    return result


def got(frame):
    rows = frame.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def texts(seed, letters="abÀñ", size=7, n=60):
    generator = random.Random(seed)
    words = ["".join(generator.choices(letters, k=generator.randrange(size, size + 4))) for _ in range(n)]
    out = []
    for i in range(40):
        row = generator.choices(words, [1 / (k + 1) ** 2 for k in range(n)], k=60)
        row = [w if generator.random() < 0.7 else w[:3] + generator.choice(letters) + w[3 + generator.randrange(2):] for w in row]
        out.append((i, generator.choice([" ", ", ", "1", "\n×"]).join(row).title() if i % 3 else " ".join(row)))
    return out


@pytest.mark.parametrize("variants", [Variants(), Variants(hot=1), Variants(min_length=3, min_count=1, times=2, hot=2, worn=3)])
def test_equals_brute_force(docs, variants):
    pairs = texts(variants.hot) + [(900, None), (901, ""), (902, "Ünïcödéß " * 3), (903, "Zzzzzzzz zzzzzzz zzzzzzzzz " * 2), (7, "abcdefg abcdefg abcdefgh abcdefgh")]
    expected = brute_force(pairs, variants)
    assert any(v[0] for v in expected.values()) and got(group_variants(docs(pairs), variants)) == expected


def test_chain_of_forms(docs):
    words = {"aaaaaaaa": 400, "aaaaaaab": 40, "aaaaaabb": 4, "aaaaabbb": 2, "aaaaaaac": 40}
    pairs = [(i, w) for w, n in words.items() for i in range(n)]
    result = got(group_variants(docs(pairs), Variants(worn=1 << 40)))
    assert result["aaaaaabb"][:2] == ("aaaaaaab", "aaaaaaaa") and result["aaaaabbb"][:2] == (None, "aaaaabbb")
    assert result["aaaaaaab"] == ("aaaaaaaa", "aaaaaaaa", 40, 3, 400)


def test_crowded_chunk_brings_no_pairs_of_all(spark, docs, monkeypatch):
    """3,000 words share their first half, and few are one edit apart: they are chunked again, not compared all with all."""
    generator = random.Random(3)
    words = sorted({"congregat" + "".join(generator.choices("abcdefghij", k=9)) for _ in range(3000)})
    words += [w[:12] + "z" + w[13:] for w in words[:50]] + [w + "z" for w in words[50:99]]
    met, plain = [], spelling_variants._met

    def counting(rows, longer):
        left = rows.filter("longer = 0").select("chunk")
        met.append(left.join(rows.select("chunk", "longer"), "chunk").count())
        return plain(rows, longer)

    monkeypatch.setattr(spelling_variants, "_met", counting)
    pairs = [(i, f"{w} {w}") for i, w in enumerate(words)]
    assert got(group_variants(docs(pairs), Variants(worn=1 << 40))) == brute_force(pairs, Variants(worn=1 << 40))
    assert sum(met) < 64 * 6 * len(words)


def test_very_long_runs_and_texts(docs):
    run = "".join(random.Random(5).choices("abc", k=50_000))
    pairs = [(1, f"{run} {run} {run[:999]}x{run[1000:]}"), (2, f"{run[:999]}x{run[1000:]} {run}q"), (3, f"{run}q " + "lettersss. " * 100_000)]
    result = got(group_variants(docs(pairs), Variants(worn=1 << 40)))
    assert {(len(w), v[3]) for w, v in result.items()} == {(50_000, 2), (50_000, 1), (50_001, 1), (9, 0)}


def test_odd_rows(spark, docs):
    assert group_variants(docs([])).collect() == []
    frame = spark.createDataFrame([(None, "abcdefgh " * 2, "x")] * 3, "doc_id long, text string, word string")
    assert sum(r.n for r in group_variants(frame).collect()) == 6
