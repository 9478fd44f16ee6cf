import numpy as np
import pyarrow as pa
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgermill.llm import textops

texts = st.lists(st.one_of(st.none(), st.text(alphabet="aB é\n\t\x0b中Z .", max_size=90)), min_size=1, max_size=8)


@settings(max_examples=150, deadline=None)
@given(texts)
def test_words_and_hashes(values):
    raw, offsets = textops.text_bytes(pa.array(values, pa.string()))
    low = textops.lower_ascii(raw)
    starts, ends, before = textops.space_words(low, offsets)
    got = [bytes(low[a:b]) for a, b in zip(starts, ends)]
    want = [(v or "").encode().lower().split() for v in values]
    assert got == [w for ws in want for w in ws]
    assert np.diff(before).tolist() == [len(ws) for ws in want]
    spaced, at, to = textops.respaced(low, starts, ends)
    assert [bytes(spaced[a:b]) for a, b in zip(at, to)] == got


@settings(max_examples=150, deadline=None)
@given(texts)
def test_distinct_words(values):
    codes, words, before = textops.distinct_words(pa.array(values, pa.string()))
    names = words.to_pylist()
    want = [[w.decode() for w in (v or "").encode().split()] for v in values]
    assert [names[c] for c in codes] == [w for ws in want for w in ws]
    assert np.diff(before).tolist() == [len(ws) for ws in want]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(max_size=150), min_size=1, max_size=6))
def test_xxh64(values):
    raw = np.frombuffer(b"".join(values), np.uint8)
    ends = np.cumsum([len(v) for v in values])
    starts = ends - [len(v) for v in values]
    assert textops.xxh64(raw, starts, ends).tolist() == [xxhash.xxh64_intdigest(v, 42) for v in values]


def test_chunks_cover_all_rows():
    batch = pa.RecordBatch.from_pydict({"t": ["a" * 50, None, "b" * 500, "", "c"]})
    parts = list(textops.chunks(batch, "t", 100))
    assert [r for p in parts for r in p.column(0).to_pylist()] == batch.column(0).to_pylist()
    assert len(parts) == 3
