import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from derrickflow.sources import blocks as B


def parts(tmp_path, n=3):
    tables = [pa.table({"k": ["a", "b", None], "v": [1.5 * i, None, 3.0], "long": ["x" * 5000, "", "é"]}) for i in range(n)]
    made = [B.write_blocks(t, [1, 3], f"file://{tmp_path}", f"p{i}", ["k"]) for i, t in enumerate(tables)]
    return tables, made


def test_footer_round_trip(tmp_path):
    _, made = parts(tmp_path, 1)
    footer = B.read_footer(made[0][0])
    assert B.Reader(B.encode(footer)).struct() == footer


def test_copied_blocks_hold_the_same_rows(tmp_path):
    tables, made = parts(tmp_path)
    take = [(uri, head, entry) for uri, head, entries in made for _, _, entry in entries]
    to = f"file://{tmp_path}/out.parquet"
    assert B.copy_blocks(take, to)[:2] == (6, 9)
    assert pq.read_table(tmp_path / "out.parquet").equals(pa.concat_tables(tables))


def test_blocks_are_copied_not_decoded(tmp_path):
    _, made = parts(tmp_path, 2)
    to = f"file://{tmp_path}/out.parquet"
    B.copy_blocks([(u, h, e) for u, h, es in made for _, _, e in es], to)
    raw = (tmp_path / "out.parquet").read_bytes()
    for uri, _, entries in made:
        data = open(uri[7:], "rb").read()
        for _, _, entry in entries:
            for chunk in B.Reader(entry).struct()[B.GROUP_COLUMNS][1][1]:
                start, size = B.chunk_range(chunk)
                assert data[start : start + size] in raw


def test_other_schema_is_refused(tmp_path):
    _, made = parts(tmp_path, 1)
    other = B.write_blocks(pa.table({"k": [1]}), [1], f"file://{tmp_path}", "q", [])
    with pytest.raises(ValueError, match="schema"):
        B.copy_blocks([(made[0][0], made[0][1], made[0][2][0][2]), (other[0], other[1], other[2][0][2])], f"file://{tmp_path}/x.parquet")


def test_no_blocks_are_refused(tmp_path):
    with pytest.raises(ValueError):
        B.copy_blocks([], f"file://{tmp_path}/x.parquet")
