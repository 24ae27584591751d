"""Writers of the landing formats: for test fixtures and for exchange with other systems."""

from __future__ import annotations

import hashlib
import json
import struct
import zlib
from collections.abc import Iterable, Iterator
from decimal import Decimal
from itertools import islice
from pathlib import Path


def _literal(v: object) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, (int, float, Decimal)):
        return str(v)
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n").replace("\t", "\\t").replace("\0", "\\0") + "'"


def _definition(table: str, columns: list[str]) -> str:
    return f"CREATE TABLE `{table}` (\n" + ",\n".join(f"  `{c}` text" for c in columns) + "\n);"


def _inserts(table: str, rows: Iterable[tuple], most: int) -> Iterator[str]:
    rows = iter(rows)
    while part := list(islice(rows, most)):
        yield f"INSERT INTO `{table}` VALUES " + ",".join(f"({','.join(map(_literal, r))})" for r in part) + ";"


def dump_lines(before: dict[str, tuple[list[str], list[tuple]]], table: str, columns: list[str], rows: Iterable[tuple], most: int = 100) -> Iterator[str]:
    """The lines of a dump of one large table after some small ones; rows are taken as they come."""
    yield "-- dump"
    for name, (named, values) in before.items():
        yield from _definition(name, named).split("\n")
        yield from _inserts(name, values, most)
    yield from _definition(table, columns).split("\n")
    yield from _inserts(table, rows, most)


def write_dump(path: Path, tables: dict[str, tuple[list[str], list[tuple]]], most: int = 100) -> None:
    out = ["-- dump"]
    for table, (columns, rows) in tables.items():
        out += [_definition(table, columns), *_inserts(table, rows, most)]
    path.write_text("\n".join(out) + "\n")


def write_psv(path: Path, columns: list[str], rows: list[tuple], total: Decimal | None = None, count: int | None = None) -> None:
    lines = ["|".join(columns), *["|".join("" if v is None else str(v) for v in r) for r in rows], f"T|{len(rows) if count is None else count}|{'' if total is None else total}"]
    path.write_text("\n".join(lines) + "\n")


def write_jsonl(path: Path, items: list[dict]) -> None:
    path.write_text("".join(json.dumps(x) + "\n" for x in items))


def write_manifest(folder: Path, source: str, day: str, entities: list[dict]) -> dict:
    files = [{"file": f.name, "bytes": f.stat().st_size, "sha256": hashlib.sha256(f.read_bytes()).hexdigest()} for f in sorted(folder.iterdir()) if not f.name.startswith("_")]
    manifest = {"source": source, "business_date": day, "batch_id": "B" + day.replace("-", ""), "entities": entities, "files": files}
    (folder / "_manifest.json").write_text(json.dumps(manifest))
    return manifest


def png(width: int, height: int, grey: int = 200) -> bytes:
    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    rows = (b"\0" + bytes([grey]) * width) * height
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")
