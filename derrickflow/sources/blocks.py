"""Parquet files as containers of encoded blocks.

A block is a row group: its column chunks lie in one byte range and are described by one footer
entry. write_blocks makes files with one block per key; copy_blocks joins blocks of many files into
one file by copying their bytes and writing a new footer. No value is decoded on the way.

The footer is in Thrift's compact protocol. Only its container format is handled here, generically:
a struct is {field id: (type, value)}, a list is (element type, [value, ...]).
"""

from __future__ import annotations

import struct
import uuid

import pyarrow as pa
import pyarrow.parquet as pq

from derrickflow.sources.files import resolve

MAGIC = b"PAR1"
TRUE, FALSE, BYTE, I16, I32, I64, DOUBLE, BINARY, LIST, SET, MAP, STRUCT = range(1, 13)

#: Field numbers of the public Parquet footer structs.
META_SCHEMA, META_ROWS, META_GROUPS = 2, 3, 4
GROUP_COLUMNS, GROUP_BYTES, GROUP_ROWS, GROUP_OFFSET, GROUP_PACKED, GROUP_ORDINAL = 1, 2, 3, 5, 6, 7
CHUNK_OFFSET, CHUNK_META = 2, 3
CHUNK_INDEXES = (4, 5, 6, 7)
COLUMN_PACKED, COLUMN_DATA, COLUMN_INDEX, COLUMN_DICT = 7, 9, 10, 11
COLUMN_BLOOM = (14, 15)


class Reader:
    """Decodes compact-protocol values from a buffer."""

    def __init__(self, data: bytes, at: int = 0):
        self.data, self.at = data, at

    def varint(self) -> int:
        out = shift = 0
        while True:
            b = self.data[self.at]
            self.at += 1
            out |= (b & 0x7F) << shift
            if b < 0x80:
                return out
            shift += 7

    def zigzag(self) -> int:
        n = self.varint()
        return (n >> 1) ^ -(n & 1)

    def value(self, kind: int):
        if kind in (I16, I32, I64):
            return self.zigzag()
        if kind == BINARY:
            n = self.varint()
            self.at += n
            return self.data[self.at - n : self.at]
        if kind == STRUCT:
            return self.struct()
        if kind in (LIST, SET):
            head = self.data[self.at]
            self.at += 1
            n, of = head >> 4, head & 15
            n = self.varint() if n == 15 else n
            return of, [self.value(of) for _ in range(n)]
        if kind in (TRUE, FALSE, BYTE):
            self.at += 1
            return self.data[self.at - 1]
        if kind == DOUBLE:
            self.at += 8
            return struct.unpack("<d", self.data[self.at - 8 : self.at])[0]
        raise ValueError(f"Thrift type {kind} isn't used by Parquet footers")

    def struct(self) -> dict:
        out, field = {}, 0
        while head := self.data[self.at]:
            self.at += 1
            kind = head & 15
            field = field + (head >> 4) if head >> 4 else self.zigzag()
            out[field] = (kind, kind == TRUE if kind in (TRUE, FALSE) else self.value(kind))
        self.at += 1
        return out


class Writer:
    """Encodes compact-protocol values."""

    def __init__(self):
        self.out = bytearray()

    def varint(self, n: int) -> None:
        while n > 0x7F:
            self.out.append(n & 0x7F | 0x80)
            n >>= 7
        self.out.append(n)

    def value(self, kind: int, v) -> None:
        if kind in (I16, I32, I64):
            self.varint((v << 1) ^ (v >> 63))
        elif kind == BINARY:
            self.varint(len(v))
            self.out += v
        elif kind == STRUCT:
            self.struct(v)
        elif kind in (LIST, SET):
            of, items = v
            if len(items) < 15:
                self.out.append(len(items) << 4 | of)
            else:
                self.out.append(0xF0 | of)
                self.varint(len(items))
            for x in items:
                self.value(of, x)
        elif kind in (TRUE, FALSE, BYTE):
            self.out.append(v)
        elif kind == DOUBLE:
            self.out += struct.pack("<d", v)
        else:
            raise ValueError(f"Thrift type {kind} isn't used by Parquet footers")

    def struct(self, fields: dict) -> None:
        last = 0
        for field in sorted(fields):
            kind, v = fields[field]
            if kind in (TRUE, FALSE):
                kind = TRUE if v else FALSE
            if 0 < field - last < 16:
                self.out.append((field - last) << 4 | kind)
            else:
                self.out.append(kind)
                self.varint((field << 1) ^ (field >> 63))
            last = field
            if kind not in (TRUE, FALSE):
                self.value(kind, v)
        self.out.append(0)


def encode(fields: dict) -> bytes:
    w = Writer()
    w.struct(fields)
    return bytes(w.out)


def read_footer(uri: str) -> dict:
    """The decoded footer of a Parquet file."""
    fs, path = resolve(uri)
    with fs.open_input_file(path) as f:
        size = f.size()
        tail = f.read_at(8, size - 8)
        if tail[4:] != MAGIC:
            raise ValueError(f"{uri} is not a Parquet file")
        n = int.from_bytes(tail[:4], "little")
        return Reader(f.read_at(n, size - 8 - n)).struct()


def chunk_range(chunk: dict) -> tuple[int, int]:
    """Start and length of a column chunk's bytes."""
    meta = chunk[CHUNK_META][1]
    first = meta[COLUMN_DATA][1]
    if COLUMN_DICT in meta and 0 < meta[COLUMN_DICT][1] < first:
        first = meta[COLUMN_DICT][1]
    return first, meta[COLUMN_PACKED][1]


def describe(uri: str) -> tuple[bytes, list[tuple[int, int, bytes]]]:
    """A file's head (its encoded footer without blocks) and (rows, bytes, encoded footer entry) of each block."""
    footer, out = read_footer(uri), []
    for group in footer[META_GROUPS][1][1]:
        size = sum(chunk_range(c)[1] for c in group[GROUP_COLUMNS][1][1])
        out.append((group[GROUP_ROWS][1], size, encode(group)))
    return encode({k: v for k, v in footer.items() if k not in (META_ROWS, META_GROUPS)}), out


def schema_key(head: bytes) -> bytes:
    """The encoded schema: blocks are compatible when theirs are the same."""
    return encode({META_SCHEMA: Reader(head).struct()[META_SCHEMA]})


def write_blocks(table: pa.Table, ends: list[int], folder: str, stem: str, stats: list[str]) -> tuple[str, bytes, list[tuple[int, int, bytes]]]:
    """Write one file with a block for each of the consecutive slices of table that end at ends.

    The name is new on each call: a repeated task attempt leaves an unused file, never a mixed one.
    """
    fs, base = resolve(folder)
    fs.create_dir(base, recursive=True)
    name = f"{stem}-{uuid.uuid4().hex[:10]}.parquet"
    with fs.open_output_stream(f"{base}/{name}") as sink, pq.ParquetWriter(sink, table.schema, compression="zstd", write_statistics=stats, store_schema=False) as w:
        start = 0
        for end in ends:
            w.write_table(table.slice(start, end - start), row_group_size=max(1, end - start))
            start = end
    uri = f"{folder}/{name}"
    return uri, *describe(uri)


def copy_blocks(blocks: list[tuple[str, bytes, bytes]], to: str) -> tuple[int, int, int]:
    """Join blocks, given as (file URI, head, encoded footer entry), into the file `to` without decoding.

    Returns blocks, rows and bytes written, all three read back from the new file's own footer by an
    independent reader. Raises ValueError if schemas differ or a count doesn't match.
    """
    out_fs, out_path = resolve(to)
    if not blocks:
        raise ValueError("no blocks")
    footer, key, known = Reader(blocks[0][1]).struct(), schema_key(blocks[0][1]), {blocks[0][1]}
    groups, rows, at = [], 0, len(MAGIC)
    inputs: dict[str, pa.NativeFile] = {}
    try:
        with out_fs.open_output_stream(out_path) as sink:
            sink.write(MAGIC)
            for uri, head, entry in blocks:
                if head not in known:
                    if schema_key(head) != key:
                        raise ValueError(f"{uri} has another schema")
                    known.add(head)
                if uri not in inputs:
                    fs, path = resolve(uri)
                    inputs[uri] = fs.open_input_file(path)
                group = Reader(entry).struct()
                begin = at
                for chunk in group[GROUP_COLUMNS][1][1]:
                    start, size = chunk_range(chunk)
                    sink.write(inputs[uri].read_at(size, start))
                    meta = chunk[CHUNK_META][1]
                    for field in (COLUMN_DATA, COLUMN_INDEX, COLUMN_DICT):
                        if field in meta and meta[field][1] > 0:
                            meta[field] = (I64, meta[field][1] - start + at)
                    for field in COLUMN_BLOOM:
                        meta.pop(field, None)
                    for field in CHUNK_INDEXES:
                        chunk.pop(field, None)
                    chunk[CHUNK_OFFSET] = (I64, 0)
                    at += size
                group[GROUP_OFFSET] = (I64, begin)
                group[GROUP_PACKED] = (I64, at - begin)
                group.pop(GROUP_ORDINAL, None)
                groups.append(group)
                rows += group[GROUP_ROWS][1]
            footer[META_ROWS] = (I64, rows)
            footer[META_GROUPS] = (LIST, (STRUCT, groups))
            tail = encode(footer)
            sink.write(tail + len(tail).to_bytes(4, "little") + MAGIC)
    finally:
        for f in inputs.values():
            f.close()
    with out_fs.open_input_file(out_path) as f:
        seen = pq.read_metadata(f)
        size = f.size()
    if (seen.num_row_groups, seen.num_rows) != (len(blocks), rows):
        raise ValueError(f"{to}: {seen.num_row_groups} blocks and {seen.num_rows} rows; expected {len(blocks)} and {rows}")
    return len(blocks), rows, size
