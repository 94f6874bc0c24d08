"""What the fits and lexicons take of the driver's memory, and that taking less changes no result."""

import tracemalloc

import numpy as np
import pyarrow as pa

from linkloom.llm import bpe, common, toxicity


def sampled(n: int, size: int, of: int) -> tuple[list[np.ndarray], np.ndarray]:
    r = np.random.default_rng(3)
    return [np.sort(r.choice(of, size, replace=False)).astype(np.int32) for _ in range(n)], r.integers(0, 2, n).astype(float)


def test_the_machine_is_fitted_in_few_bytes_for_each_term_of_the_sample():
    hashes, labels = sampled(6000, 250, 300)
    tracemalloc.start()
    toxicity.fit(hashes, labels, 0.5, epochs=1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 12 * sum(map(len, hashes)) + 8 * (8 << toxicity.BITS), peak


def test_pairs_counted_in_parts_are_all_pairs(monkeypatch):
    hashes, _ = sampled(300, 8, 40)
    labels = np.array([float((1 in h) == (2 in h)) for h in hashes])
    whole = toxicity.in_pairs(hashes, labels).tolist()
    assert {1, 2} <= set(whole)
    monkeypatch.setattr(toxicity, "TOGETHER", 3)
    assert toxicity.in_pairs(hashes, labels).tolist() == whole


def test_lists_of_the_sample_are_views_in_order():
    rows = [[5, 1, 3], [], [2], [9, 8], [], [7, 4]]
    column = pa.chunked_array([pa.array(rows[:4], pa.list_(pa.int32())).slice(1), pa.array(rows[4:], pa.list_(pa.int32()))])
    found = toxicity.in_order(column)
    assert [x.tolist() for x in found] == [sorted(x) for x in rows[1:]] and len({id(x.base) for x in found}) == 1
    assert toxicity.in_order(pa.chunked_array([], pa.list_(pa.int32()))) == []


def test_files_go_to_the_shared_folder_in_pieces(spark, monkeypatch):
    data, pieces, place = np.random.default_rng(1).bytes(common.PIECE_BYTES * 2 + 5), [], common._place

    class Store:
        def __init__(self, path):
            self.path, self.store = place(spark, path)

        def create(self, path):
            self.stream = self.store.create(path)
            return self

        def write(self, piece):
            pieces.append(len(piece))
            self.stream.write(piece)

        def close(self):
            self.stream.close()

    path = f"{common.fresh_folder(spark, 'pieces')}/file"
    monkeypatch.setattr(common, "_place", lambda spark, path: ((s := Store(path)).path, s))
    common.put_bytes(spark, path, data)
    files, own = common.opened(path)
    with files.open_input_stream(own) as f:
        assert f.read() == data
    assert max(pieces) <= 1 << 18


def test_a_lexicon_merged_in_parts_is_the_same_file(monkeypatch):
    words = [b"plain", b" words", b"x" * 70, " grün".encode(), b"ab", b" q"]
    whole = bpe.compiled(bpe.default_vocabulary(), words)
    monkeypatch.setattr(bpe, "MERGED", 2)
    assert bpe.compiled(bpe.default_vocabulary(), words) == whole == bpe.compiled(bpe.default_vocabulary(), words[::-1])
    assert bpe.compiled(bpe.default_vocabulary(), [])
