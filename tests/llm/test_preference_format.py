from __future__ import annotations

import random
import re

from review_signals.llm.preference_format import branch_pairs, format_pairs
from review_signals.llm.queries import REGISTRY

from .conftest import SF_DIR

TURNS = "pair_id long, turn long, role string, text string"


def render(turns):
    return "".join(f"<|im_start|>{role}\n{text}<|im_end|>\n" for role, text in turns)


def mask(turns):
    place, spans = 0, []
    for role, text in turns:
        start = place + len("<|im_start|>") + len(role) + 1
        place = start + len(text) + len("<|im_end|>\n")
        if role == "assistant":
            spans.append((start, place))
    return spans


def brute_force(chosen, rejected):
    def sides(rows):
        by_pair = {}
        for pair, turn, role, text in set(rows):
            by_pair.setdefault(pair, []).append((turn is not None, turn or 0, role or "", text or ""))
        return {pair: [turn[2:] for turn in sorted(set(turns))] for pair, turns in by_pair.items() if pair is not None}

    c, r = sides(chosen), sides(rejected)
    result = {}
    for pair in {*c, *r}:
        a, b = c.get(pair, []), r.get(pair, [])
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        result[pair] = n, render(a[:n]), render(a[n:]), mask(a[n:]), render(b[n:]), mask(b[n:])
    return result


def found(frame):
    return {r.pair_id: (r.n_prompt_turns, r.prompt, r.chosen, [tuple(m) for m in r.chosen_mask], r.rejected, [tuple(m) for m in r.rejected_mask])
            for r in frame.collect()}


def test_equals_brute_force(spark):
    generator = random.Random(6)
    sides = []
    for _ in range(2):
        rows = []
        for pair in range(80):
            for turn in range(generator.randrange(6)):
                rows.append((pair, turn, ["user", "assistant", None][turn % 2 if generator.random() < 0.9 else 2],
                             generator.choice(["hi", "hi", "héllo 😀", "", None, "long " * 2000])))
        rows += rows[:10] + [(None, 0, "user", "lost"), (500, None, "user", "x"), (500, 3, "user", "b"), (500, 3, "user", "a")]
        sides.append(rows)
    frames = [spark.createDataFrame(rows, TURNS).selectExpr("*", "1 as n", "2 as prompt") for rows in sides]
    assert found(format_pairs(*frames)) == brute_force(*sides)


def test_one_side_missing_equal_sides_and_empty_tables(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b")]
    frame, nothing = spark.createDataFrame(rows, TURNS), spark.createDataFrame([], TURNS)
    assert found(format_pairs(frame, nothing)) == brute_force(rows, [])
    assert found(format_pairs(frame, frame))[1] == (2, render([("user", "a"), ("assistant", "b")]), "", [], "", [])
    assert found(format_pairs(nothing, nothing)) == {}


def test_masks_cover_what_the_assistant_says(spark):
    frame = spark.read.parquet(f"{SF_DIR}/conversations.parquet")
    for row in format_pairs(*branch_pairs(frame)).collect():
        for text, spans in ((row.chosen, row.chosen_mask), (row.rejected, row.rejected_mask)):
            said = re.findall(r"<\|im_start\|>assistant\n(.*?<\|im_end\|>\n)", text, re.S)
            assert [text[s.start:s.end] for s in spans] == said


def test_every_conversation_makes_a_pair_without_python(spark):
    frame = REGISTRY["op1_preference_format"](spark, SF_DIR)
    assert frame.count() == spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id").distinct().count()
    assert not re.search("Python|Pandas|Arrow", frame._jdf.queryExecution().executedPlan().toString())
