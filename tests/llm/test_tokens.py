"""Token files and packing: exact round trips and limits."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fleetpulse.llm import packing, token_files
from fleetpulse.llm.encoders import PieceEncoder
from fleetpulse.llm.queries import tokenizer_path
from fleetpulse.session import ensure_checkpoint_dir

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
ODD = ["", "a", " a", "a ", "a  b", "a\nb", "a\n\nb", "a \n b", "\t", "x\ty z", "don't stop, I'll 'Ve", "THE!! X### a_b. 3.5 ...,",
       "<|endoftext|> a<|endoftext|>", "İstanbul ΣΑΣ ς", "é é ́x", "a b\x00c", "日本語 テキスト", "😀 a.b,c", "123 45.67,8", ".a ,b", "a." * 50]


@pytest.fixture(scope="module", params=FILES)
def both(request):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer_path(request.param))
    whole.encode_special_tokens = True
    return whole, PieceEncoder(tokenizer_path(request.param), cache_pieces=50)


def test_pieces_equal_whole_text(both):
    whole, pieces = both
    found = list(pieces.encode_all(pa.array([*ODD, None])))
    for text, ids in zip([*ODD, ""], found):
        assert ids.tolist() == whole.encode(text, add_special_tokens=False).ids, text


@settings(max_examples=300, deadline=None)
@given(text=st.text(alphabet=st.sampled_from(list("aBé ,.!'\n\t12_- ßΣ́|")), max_size=40))
def test_random_texts(text):
    from tokenizers import Tokenizer

    for name in FILES:
        kept = test_random_texts.__dict__.setdefault(name, None)
        if kept is None:
            whole = Tokenizer.from_file(tokenizer_path(name))
            whole.encode_special_tokens = True
            kept = test_random_texts.__dict__[name] = (whole, PieceEncoder(tokenizer_path(name)))
        assert next(kept[1].encode_all(pa.array([text]))).tolist() == kept[0].encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=20), max_size=6))
def test_rank_coding_round_trip(docs):
    counts = np.array([len(d) for d in docs], dtype=np.int64)
    control, data = token_files.encode_ranks(np.array(sum(docs, []), dtype=np.uint32), counts)
    assert [len(c) for c in control] == [-(-len(d) // 4) for d in docs]
    assert token_files.decode_ranks(control, data, counts).tolist() == sum(docs, [])


DOCS = "doc_id long, text string, id string, start int, rank int"


def test_token_files(spark, frame):
    from tokenizers import Tokenizer

    texts = [(5, "a b c"), (3, None), (9, ""), (3, "a b c"), (None, "x"), (7, "the and the " * 2000)] + [(4, f"t{i}") for i in range(40)]
    docs = frame([(i, t, "c", 1, 2) for i, t in texts], DOCS)
    path = ensure_checkpoint_dir(spark) + "/token-files-test"
    token_files.write(docs, path, tokenizer_path(FILES[0]), parts=5)
    rows = token_files.read(spark, path).collect()
    whole = Tokenizer.from_file(tokenizer_path(FILES[0]))
    want = sorted((i is not None, i or 0, tuple(whole.encode(t or "", add_special_tokens=False).ids) + (0,)) for i, t in texts)
    assert sorted((r.doc_id is not None, r.doc_id or 0, tuple(r.ids)) for r in rows) == want
    at = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at and r.n_tokens == len(r.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes())
        at += r.n_tokens
    order = [r.doc_id for r in sorted(rows, key=lambda r: r.start)]
    assert order[0] is None and order[1:] == sorted(order[1:])
    ranks = spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()
    assert [r["count"] for r in ranks] == sorted((r["count"] for r in ranks), reverse=True)


def test_token_files_empty(spark, frame):
    path = ensure_checkpoint_dir(spark) + "/token-files-empty"
    token_files.write(frame([], DOCS), path, tokenizer_path(FILES[0]))
    assert token_files.read(spark, path).count() == 0


def check_packed(rows, limits, tokens_of):
    sequences, docs = {}, {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append(r)
        docs.setdefault((r.doc_id, r.doc_tokens), []).append(r)
        assert r.length > 0 and len(r.ids) == r.length
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes())
    for pieces in sequences.values():
        pieces.sort(key=lambda r: r.offset)
        assert [r.offset for r in pieces] == np.cumsum([0] + [r.length for r in pieces[:-1]]).tolist()
        total = sum(r.length for r in pieces)
        assert total <= limits.tokens and (total == limits.tokens or total & (total - 1) == 0)
        assert len(pieces) <= limits.segments
        assert sum(r.loss_tokens for r in pieces) <= limits.loss_tokens
    assert sum(r.length for r in rows) == tokens_of
    return docs


@pytest.mark.parametrize("limits", [packing.Limits(), packing.Limits(64, 3, 40, 4), packing.Limits(32, 2, 5, 1)])
def test_packing(frame, limits):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer_path(FILES[1]))
    texts = {i: "the cat sat " * (i * i % 37) for i in range(60)} | {99: None, 98: "", 97: "word " * 9000}
    docs = frame([(i, t, "c", 3, 2) for i, t in texts.items()], DOCS)
    rows = packing.pack(docs, tokenizer_path(FILES[1]), limits=limits, loss_from="start").collect()
    want = {i: whole.encode(t or "", add_special_tokens=False).ids + [2] for i, t in texts.items()}
    found = check_packed(rows, limits, sum(map(len, want.values())))
    for (i, n), pieces in found.items():
        pieces.sort(key=lambda r: r.start)
        assert n == len(want[i]) and sum((r.ids for r in pieces), []) == want[i]
        assert sum(r.loss_tokens for r in pieces) == max(0, n - 3)


def test_packing_odd_rows(frame):
    docs = frame([(None, "a", "c", 1, 2), (None, "a", "c", 1, 2), (1, None, None, None, None)], DOCS)
    rows = packing.pack(docs, tokenizer_path(FILES[1])).collect()
    assert sorted(str(r.doc_id) for r in rows) == ["1", "None", "None"] and {r.doc_tokens for r in rows} == {1, 2}
    assert packing.pack(frame([], DOCS), tokenizer_path(FILES[1])).collect() == []
    assert packing.pack(docs.where("doc_id = 1"), tokenizer_path(FILES[1]), end_id=None).collect() == []
    with pytest.raises(ValueError):
        packing.pack(docs, tokenizer_path(FILES[1]), limits=packing.Limits(segments=0))


def test_packing_pads_nothing_and_mixes_long_and_short():
    packer = packing.Packer(packing.Limits(100, 4, 100, 8))
    out = [s for i, n in enumerate([97, 1, 1, 1, 50, 50, 250]) for s in packer.add(i, n, 0)]
    out += packer.finish()
    assert sum(p.length for s in out for p in s) == 450
    assert sum(sum(p.length for p in s) == 100 for s in out) >= 4
    assert packing.power_lengths(13) == [8, 4, 1]
