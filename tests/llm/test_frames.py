import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from surveyloom.llm import frames


@pytest.mark.parametrize("copies", [3, 1 << 16])
def test_offsets_of_repeated_rows(spark, monkeypatch, copies):
    """Gapless sums in every group, whatever repeats, and no bucket with the copies of one row."""
    monkeypatch.setattr(frames, "COPIES", copies)
    rows = [("a", i % 50, i % 7) for i in range(300)] + [("a", None, 5)] * 400 + [("b", 1, 2)] * 10 + [("c", 1, 0)] * 3
    df = spark.createDataFrame(rows, "g string, i long, v long")
    got = frames.with_offsets(df, ["g"], ["i", "v"], F.col("v"), 8, "at")
    assert got.columns == ["g", "i", "v", "at"]
    found = [tuple(r) for r in got.collect()]
    assert sorted(map(str, (r[:3] for r in found))) == sorted(map(str, rows))
    for group in "abc":
        own = sorted((at, at + v) for g, _, v, at in found if g == group and v)
        assert all(end == start for (_, end), (start, _) in zip(own, own[1:])) and (not own or own[0][0] == 0)
    again = [tuple(r) for r in frames.with_offsets(df.repartition(5), ["g"], ["i", "v"], F.col("v"), 8, "at").collect()]
    assert sorted(map(str, again)) == sorted(map(str, found))
    assert frames.with_offsets(df.limit(0), ["g"], ["i", "v"], F.col("v"), 8, "at").count() == 0


def test_matrix_of_ragged_vectors():
    vectors = pa.array([[1.0, 2.0], [], [3.0]], pa.list_(pa.float32()))
    assert frames.matrix(vectors, 3).tolist() == [[1, 2, 0], [0, 0, 0], [3, 0, 0]]
    assert frames.matrix(vectors.slice(2), 2).tolist() == [[3, 0]]
    assert frames.matrix(pa.array([[1, 2], [3, 4]], pa.list_(pa.int32())), 2).tolist() == [[1, 2], [3, 4]]


def test_a_worker_keeps_one_object():
    made = []

    def ask(key):
        return frames.kept_by_worker(key, lambda: made.append(key) or [key])

    first = ask("a")
    assert ask("a") is first and made == ["a"]
    assert ask("b") == ["b"] and ask("a") == ["a"] and made == ["a", "b", "a"]
