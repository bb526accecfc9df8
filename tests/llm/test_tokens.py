import random

import numpy as np
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from qrelmill.llm import sentence_pieces, token_counts
from tests.llm.util import SCHEMA, awkward, with_clashes

JSON = public_tokenizers.path("byte_bpe_50k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = Tokenizer.from_file(JSON)
PIECES = sentencepiece.SentencePieceProcessor(model_file=MODEL)
MIXED = st.text(st.sampled_from("ab \n\t'slverdt1٣é漢ßThe.,!?<|>_  ▁😀\x85\xa0"), max_size=60)


@settings(max_examples=300, deadline=None)
@given(MIXED)
def test_counts_as_the_library(text):
    assert token_counts.compiled(JSON).count(text) == len(LIBRARY.encode(text, add_special_tokens=False).ids)


@settings(max_examples=200, deadline=None)
@given(MIXED, st.integers(1, 9))
def test_chunk_maps_compose(text, size):
    machine = token_counts.compiled(JSON)
    maps = [token_counts.chunk_map(machine, text[i : i + size]) for i in range(0, max(1, len(text)), size)]
    assert token_counts.reduce_maps(machine, maps) == machine.count(text)
    left = maps[0]
    for m in maps[1:]:
        left = token_counts.compose(machine, left, m)
    assert token_counts.reduce_maps(machine, [left]) == machine.count(text)


def test_special_strings_and_new_letters():
    machine = token_counts.compiled(JSON)
    for text in ("<|endoftext|>", "a  <|endoftext|>  b<|endoftext|>", "don't 's ''s", "Ᲊᲊ x", "  " * 300, "z" * 4000):
        assert machine.count(text) == len(LIBRARY.encode(text, add_special_tokens=False).ids)


def test_states_may_be_dropped(monkeypatch):
    monkeypatch.setattr(token_counts, "MAX_STATES", 50)
    monkeypatch.setattr(token_counts, "MAX_WORDS", 3)
    machine = token_counts.Transducer(JSON)
    text = "Every unusual vocabulary item here forces transitions that were thrown away before. " * 3
    assert machine.count(text) == len(LIBRARY.encode(text, add_special_tokens=False).ids)


def test_token_counts_of_awkward_documents(spark):
    docs = awkward(spark)
    want = sorted(
        (
            (r["doc_id"], len((r["text"] or "").encode()), n := len(LIBRARY.encode(r["text"] or "", add_special_tokens=False).ids), n > 512)
            for r in docs.collect()
        ),
        key=str,
    )
    for chunk in (97, 1 << 16):
        got = token_counts.token_counts(with_clashes(docs), JSON, chunk_chars=chunk)
        assert sorted(map(tuple, got.collect()), key=str) == want
    assert token_counts.token_counts(spark.createDataFrame([], SCHEMA), JSON).count() == 0


@settings(max_examples=300, deadline=None)
@given(MIXED)
def test_pieces_as_the_library(text):
    model = sentence_pieces.loaded(MODEL)
    ids = np.frombuffer(model.encode(text), np.int32).tolist()
    assert ids == PIECES.encode(text)
    assert model.decode(ids) == text.replace("▁", " ")


def test_window_commits_before_the_end():
    model = sentence_pieces.loaded(MODEL)
    rng = random.Random(3)
    text = "".join(rng.choice("abcdefgh") for _ in range(5000))
    stream, seen = model.segment(text), 0
    for _ in range(50):
        seen += len("".join(next(stream)))
    rest = "".join("".join(run) for run in stream)
    assert 0 < seen < len(text) and text.endswith(rest) and seen + len(rest) == len(text)
    assert np.frombuffer(model.encode(text), np.int32).tolist() == PIECES.encode(text)


def test_unigram_search_is_optimal():
    model = sentence_pieces.PieceModel(MODEL, model_type=sentence_pieces.UNIGRAM)
    rng = random.Random(4)
    for _ in range(60):
        text = "▁" + "".join(rng.choice("theandi▁o") for _ in range(rng.randrange(1, 70)))
        best = [0.0] + [-1e18] * len(text)
        for end in range(1, len(text) + 1):
            for start in range(max(0, end - model.longest), end):
                s = model.score.get(text[start:end], model.unknown_score if end - start == 1 else None)
                if s is not None:
                    best[end] = max(best[end], best[start] + s)
        pieces = [p for run in model.segment(text) for p in run]
        assert "".join(pieces) == text
        assert abs(sum(model.score.get(p, model.unknown_score) for p in pieces) - best[-1]) < 1e-6 * abs(best[-1]) + 1e-6


def test_encoding_awkward_documents(spark):
    docs = awkward(spark)
    got = sentence_pieces.encode_checked(with_clashes(docs), MODEL).collect()
    want = [(r["doc_id"], PIECES.encode(r["text"] or "")) for r in docs.collect()]
    assert sorted(((r["doc_id"], r["ids"]) for r in got), key=str) == sorted(want, key=str)
    assert all(r["round_trip"] and r["n_ids"] == len(r["ids"]) for r in got)
    back = sentence_pieces.decode(sentence_pieces.encode(docs, MODEL), MODEL)
    texts = sorted(((r["doc_id"], (r["text"] or "").replace("▁", " ")) for r in docs.collect()), key=str)
    assert sorted(map(tuple, back.collect()), key=str) == texts
    assert sentence_pieces.encode_checked(spark.createDataFrame([], SCHEMA), MODEL).count() == 0
