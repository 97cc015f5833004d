"""Spectra of imzML files: the XML part names places in the binary part, which are read by ranges.

``spark.read.format("imzml")`` (after ``register``) splits the spectra among tasks; each reads only its own bytes of the
.ibd file, so a file of any size is read. Paths must be visible to driver and executors as files (a shared or mounted
folder); ``tables.read_imzml`` has the way for others.
"""

from __future__ import annotations

import os
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "x int, y int, mz array<double>, intensity array<double>"
#: Spectra and bytes that one task reads.
SPECTRA, BYTES = 4096, 64 << 20

# Terms of the controlled vocabularies.
TYPES = {"MS:1000521": "<f4", "MS:1000523": "<f8", "MS:1000519": "<i4", "MS:1000522": "<i8"}
MZ, X, Y, OFFSET, LENGTH = "MS:1000514", "IMS:1000050", "IMS:1000051", "IMS:1000102", "IMS:1000103"


@dataclass(frozen=True)
class Spectrum:
    """Coordinates, and (offset, length, type) of both arrays."""

    x: int
    y: int
    mz: tuple[int, int, str]
    intensity: tuple[int, int, str]

    def size(self) -> int:
        return sum(n * np.dtype(t).itemsize for _, n, t in (self.mz, self.intensity))


def spectra(source) -> Iterator[Spectrum]:
    """Spectra of an imzML file or stream, one at a time: elements are let go as they end."""
    local = lambda e: e.tag.rpartition("}")[2]
    terms = lambda e: {c.get("accession"): c.get("value", "") for c in e.iter() if local(c) == "cvParam"}
    groups: dict[str, dict[str, str]] = {}
    for _, e in ET.iterparse(source):
        if local(e) == "referenceableParamGroup":
            groups[e.get("id")] = terms(e)
        elif local(e) == "spectrum":
            arrays = {}
            for a in e.iter():
                if local(a) == "binaryDataArray":
                    own = terms(a)
                    for ref in a:
                        if local(ref) == "referenceableParamGroupRef":
                            own = groups.get(ref.get("ref"), {}) | own
                    arrays[MZ in own] = int(own[OFFSET]), int(own[LENGTH]), next(t for k, t in TYPES.items() if k in own)
            at = terms(e)
            yield Spectrum(int(at[X]), int(at[Y]), arrays[True], arrays[False])
            e.clear()


def decoded(raw: bytes, kind: str) -> list[float]:
    return np.frombuffer(raw, kind).astype(float).tolist()


class Part(InputPartition):
    def __init__(self, chosen: list[Spectrum]):
        self.chosen = chosen


class Reader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[Part]:
        out, held, size = [], [], 0
        for s in spectra(f"{self.path}.imzML"):
            if held and (len(held) >= SPECTRA or size + s.size() > BYTES):
                out.append(Part(held))
                held, size = [], 0
            held.append(s)
            size += s.size()
        return [*out, Part(held)]

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([("x", pa.int32()), ("y", pa.int32()), ("mz", pa.list_(pa.float64())), ("intensity", pa.list_(pa.float64()))])
        with open(f"{self.path}.ibd", "rb") as f:

            def array(offset: int, length: int, of: str) -> list[float]:
                f.seek(offset)
                return decoded(f.read(length * np.dtype(of).itemsize), of)

            for k in range(0, len(partition.chosen), 256):
                some = partition.chosen[k : k + 256]
                yield pa.RecordBatch.from_pydict({"x": [s.x for s in some], "y": [s.y for s in some], "mz": [array(*s.mz) for s in some], "intensity": [array(*s.intensity) for s in some]}, schema=kind)


class ImzmlSource(DataSource):
    """Format "imzml": option path names both files without their extensions."""

    @classmethod
    def name(cls) -> str:
        return "imzml"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> Reader:
        return Reader(local_path(self.options["path"]))


def local_path(path: str) -> str:
    return path.removeprefix("file://").removeprefix("file:")


def is_file(path: str) -> bool:
    return os.path.exists(f"{local_path(path)}.imzML")


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ImzmlSource)


def write_files(path: str, rows: list[tuple[int, int, list[float], list[float]]]) -> None:
    """A pair of files with the given spectra (x, y, mz, intensity): doubles, each array after the one before."""
    term = lambda a, v="": f'<cvParam accession="{a}" value="{v}"/>'
    at, body, xml = 16, [b"\0" * 16], []
    for x, y, mz, intensity in rows:
        arrays = []
        for kind, values in (("m", mz), ("i", intensity)):
            raw = np.array(values, "<f8").tobytes()
            arrays.append(f'<binaryDataArray><referenceableParamGroupRef ref="{kind}"/>{term(OFFSET, at)}{term(LENGTH, len(values))}</binaryDataArray>')
            body.append(raw)
            at += len(raw)
        xml.append(f"<spectrum>{term(X, x)}{term(Y, y)}{''.join(arrays)}</spectrum>")
    groups = "".join(f'<referenceableParamGroup id="{k}">{term(t)}{term("MS:1000523")}</referenceableParamGroup>' for k, t in (("m", MZ), ("i", "MS:1000515")))
    with open(f"{path}.ibd", "wb") as f:
        f.write(b"".join(body))
    with open(f"{path}.imzML", "w") as f:
        f.write(f'<mzML xmlns="http://psi.hupo.org/ms/mzml">{groups}{"".join(xml)}</mzML>')
