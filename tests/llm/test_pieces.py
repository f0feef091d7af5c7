"""Encoding against the public library, and round trips."""

import os
import random

import pytest

from playtrail.llm.pieces import BPE, BYTE, MARK, MODEL, NORMAL, UNIGRAM, UNKNOWN, Model, PieceTransducer

given = pytest.mark.skipif(not os.path.isfile(MODEL), reason="no model file here")


@pytest.fixture(scope="module")
def both():
    library = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=MODEL)
    with open(MODEL, "rb") as file:
        return PieceTransducer(Model.parse(file.read())), library


def texts():
    draw = random.Random(4)
    yield from ["", " ", "  a  b ", "\n\n x", "héllo wörld 日本語 🎉", MARK + "x", "a" * 300, "<s> </s> <0x0A>", "\tab\r\n", "é" * 50]
    for _ in range(300):
        yield "".join(draw.choice("abethin .,▁\n日🎉<s>0x0A  éü") for _ in range(draw.randrange(1, 80)))


@given
def test_agrees_with_the_library(both):
    machine, library = both
    for text in texts():
        ids = library.encode(text)
        assert machine.encode(text) == ids, text
        assert machine.decode(ids) == library.decode(ids), text


@given
def test_documents_agree_with_the_library(both, spark, sf_dir):
    machine, library = both
    for row in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60).collect():
        ids = library.encode(row.text or "")
        assert machine.encode(row.text or "") == ids
        assert machine.decode(ids) == (row.text or "")


def small(kind, **scores):
    pieces = ["<unk>", *scores, *(f"<0x{k:02X}>" for k in range(256))]
    kinds = [UNKNOWN, *[NORMAL] * len(scores), *[BYTE] * 256]
    return PieceTransducer(Model(pieces, [0.0, *scores.values(), *[0.0] * 256], kinds, kind, True, False))


def test_unigram_takes_the_best_sum():
    machine = small(UNIGRAM, a=-3.0, b=-3.0, ab=-4.0, aba=-9.0, **{MARK: -1.0, MARK + "a": -2.5})
    names = [machine.model.pieces[n] for n in machine.encode("abab")]
    assert names == [MARK, "ab", "ab"]
    assert machine.decode(machine.encode("ab c é")) == "ab c é"  # unknown characters are spelled in bytes


def test_merges_go_by_score_not_by_length():
    machine = small(BPE, a=-9.0, b=-9.0, c=-9.0, bc=-1.0, ab=-2.0, **{MARK: -9.0})
    names = [machine.model.pieces[n] for n in machine.encode("abc")]
    assert names == [MARK, "a", "bc"]


def test_other_models_are_refused():
    with pytest.raises(ValueError):
        Model.parse(bytes([0x12, 2, 24, 4]))  # a trainer with a kind of model of its own
