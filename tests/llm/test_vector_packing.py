from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from review_signals.llm.queries import REGISTRY
from review_signals.llm.text_arrays import as_texts
from review_signals.llm.tokens import encoder, vocabulary
from review_signals.llm.vector_packing import Limits, Packer, pack

from .conftest import SF_DIR

ODD = [None, "", "  \n ", "naïve ＡＢＣ İstanbul Σας", "don't we'll o'clock.'s 12 4a5 a1,b2", "…... “q”.", "<|endoftext|> x",
       "a​b   c\u0085d \x1c e", "word " * 9000, "A.B.C", "ÀÉß ẞ ﬁ ½"]


def plain_tokenizer():
    tokenizer = Tokenizer.from_file(vocabulary())
    tokenizer.encode_special_tokens = True
    return tokenizer


def check_pieces(rows, texts, limits=Limits()):  # noqa: B008
    tokenizer = plain_tokenizer()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for row in rows:
        by_doc[row.doc_id].append(row)
        by_sequence[row.sequence_id].append(row)
    assert set(by_doc) == set(texts)
    for doc_id, pieces in by_doc.items():
        ids = [*tokenizer.encode(texts[doc_id] or "", add_special_tokens=False).ids, limits.end_id]
        place = 0
        for piece in sorted(pieces, key=lambda p: p.start):
            assert piece.start == place and piece.doc_tokens == len(ids) and piece.length > 0
            place += piece.length
            assert piece.ids_crc32 == zlib.crc32(np.array(ids[piece.start:place], "<u4").tobytes())
        assert place == len(ids)
    padding = total = 0
    for pieces in by_sequence.values():
        place = 0
        for piece in sorted(pieces, key=lambda p: p.offset):
            assert piece.offset == place
            place += piece.length
        assert place <= limits.max_tokens and len(pieces) <= limits.max_segments
        assert sum(p.loss_tokens for p in pieces) <= limits.max_loss
        total += place
        padding += 0 if place & (place - 1) == 0 else limits.max_tokens - place
    return padding / total


def test_encoder_equals_the_whole_tokenizer():
    signs = "aB é.,!'s\n\t#12ß…Çı" + "́　"
    generator = random.Random(3)
    texts = [t or "" for t in ODD] + ["".join(generator.choices(signs, k=40)) for _ in range(400)]
    got = [ids.tolist() for ids in encoder(vocabulary()).encode(as_texts(pa.array(texts)))]
    tokenizer = plain_tokenizer()
    assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_odd_texts(docs):
    texts = dict(enumerate(ODD))
    assert check_pieces(pack(docs(texts.items()), vocabulary()).collect(), texts) == 0


def test_tight_limits(docs):
    generator = random.Random(1)
    texts = {i: "word " * generator.choice([1, 2, 30, 200]) for i in range(300)}
    limits = Limits(max_tokens=256, max_segments=5, max_loss=255, pool=32, min_cut=8)
    assert check_pieces(pack(docs(texts.items()), vocabulary(), limits).collect(), texts, limits) < 0.5


def plain_packing(documents, limits):
    """The same rules with plain lists: (doc, start, length) of each sequence, before the last ones become powers of two."""
    done, waiting = [], []
    limit = (limits.max_tokens, limits.max_segments, limits.max_loss)

    def demand(piece):
        _, start, length, prompt = piece
        return length, 1, sum(place >= prompt for place in range(start, start + length))

    def prefix(piece, tokens, loss):
        doc, start, length, prompt = piece
        return max(n for n in range(length + 1) if n <= tokens and demand((doc, start, n, prompt))[2] <= loss)

    def fill(keep):
        while len(waiting) > keep:
            room, chosen = list(limit), []
            while fits := [p for p in waiting if all(a <= b for a, b in zip(demand(p), room, strict=True))]:
                best = max(fits, key=lambda p: round(sum(a * b / c**2 for a, b, c in zip(demand(p), room, limit, strict=True)), 12))
                chosen.append(best)
                waiting.remove(best)
                room = [b - a for a, b in zip(demand(best), room, strict=True)]
            if waiting and room[1] and room[0] >= limits.min_cut:
                doc, start, length, prompt = best = max(waiting, key=lambda p: p[2])
                size = prefix(best, room[0], room[2])
                if size >= limits.min_cut:
                    chosen.append((doc, start, size, prompt))
                    waiting[waiting.index(best)] = (doc, start + size, length - size, prompt)
            done.append([piece[:3] for piece in chosen])

    def wait(piece):
        waiting.append(piece)
        if len(waiting) >= limits.pool:
            fill(limits.pool // 2)

    for doc, length, prompt in documents:
        piece = (doc, 0, length, max(prompt, 1))
        while (size := prefix(piece, limits.max_tokens, limits.max_loss)) < piece[2]:
            part, piece = (doc, piece[1], size, piece[3]), (doc, piece[1] + size, piece[2] - size, piece[3])
            if size == limits.max_tokens:
                done.append([part[:3]])
            else:
                wait(part)
        wait(piece)
    fill(0)
    return done


@pytest.mark.parametrize("seed", range(12))
def test_choices_equal_a_plain_packer(seed):
    generator = random.Random(seed)
    limits = generator.choice([
        Limits(max_tokens=64, max_segments=4, max_loss=64, pool=16, min_cut=4),
        Limits(max_tokens=64, max_segments=8, max_loss=24, pool=16, min_cut=4),
        Limits(max_tokens=64, max_segments=3, max_loss=5, pool=9, min_cut=1),
        Limits(max_tokens=64, max_segments=1, max_loss=63, pool=4, min_cut=8),
    ])
    documents = [(i, generator.choice([1, 2, 7, 20, 63, 64, 65, 150]) + generator.randrange(5), generator.choice([0, 0, 1, 10, 60, 200]))
                 for i in range(120)]
    got = []
    packer = Packer(limits, lambda pieces: got.append([(p.doc_id, p.start, len(p.ids)) for p in pieces]))
    packer._powers = lambda pieces: packer.emit(pieces)
    for doc, length, prompt in documents:
        packer.add(doc, np.arange(length), prompt)
    packer.finish()
    assert got == plain_packing(documents, limits)


@pytest.mark.parametrize("max_loss", [256, 255, 100, 10, 1])
def test_loss_limit_binds_with_prompts_and_long_documents(docs, max_loss):
    generator = random.Random(2)
    texts = {i: "word " * generator.choice([0, 1, 30, 200, 900]) for i in range(120)}
    limits = Limits(max_tokens=256, max_segments=5, max_loss=max_loss, pool=32, min_cut=8)
    prompts = "case when doc_id % 3 = 0 then null when doc_id % 3 = 1 then doc_id else 100000 - doc_id * 1000 end as n_prompt"
    rows = pack(docs(texts.items()).selectExpr("*", prompts, "9 as prompt"), vocabulary(), limits, "n_prompt").collect()
    check_pieces(rows, texts, limits)
    learned = defaultdict(int)
    for row in rows:
        learned[row.doc_id] += row.loss_tokens
    lengths = {row.doc_id: row.doc_tokens for row in rows}
    expected = {i: max(0, lengths[i] - max(1, 0 if i % 3 == 0 else i if i % 3 == 1 else 100000 - i * 1000)) for i in texts}
    assert learned == expected and max(expected.values()) > max_loss


def test_empty_table_and_clashing_columns(spark, docs):
    assert pack(docs([]), vocabulary()).collect() == []
    rows = pack(docs([(1, "a b")]).selectExpr("*", "'x' as start", "7 as sequence_id"), vocabulary()).collect()
    assert [(r.start, r.length) for r in sorted(rows, key=lambda r: r.start)] == [(0, 2), (2, 1)]


def test_null_id_and_repeated_rows(spark):
    rows = pack(spark.createDataFrame([(None, "a"), (4, "b c"), (4, "b c")], "doc_id long, text string"), vocabulary()).collect()
    assert sum(r.length for r in rows if r.doc_id is None) == 2
    assert sum(r.length for r in rows if r.doc_id == 4) == 6


def test_whole_table(spark):
    texts = dict(spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect())
    assert check_pieces(REGISTRY["op6_vector_packing"](spark, SF_DIR).collect(), texts) < 0.01
