"""Cell labels of reads: three sections between linkers, with errors."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.reads import SECTION_STARTS, whitelist_index
from ..session import ship

LIMITS = (4, 4, 2)


@dataclass
class LabelScheme:
    """Whitelists of the three sections (fixed size, given by the user), the two linkers, and the label version.

    For errors a section is judged with its linker. ``joint`` is a base that version 2 has after the second linker.
    """

    sections: list[list[str]]
    linkers: tuple[str, str]
    version: int = 1

    @property
    def joint(self) -> str:
        return "A" if self.version == 2 else ""

    @property
    def judged(self) -> list[list[str]]:
        a, b, c = self.sections
        return [[w + self.linkers[0] for w in a], [w + self.linkers[1] + self.joint for w in b], list(c)]


def distance(a: str, b: str, limit: int) -> int:
    """Edit distance, or ``limit + 1`` if it is more."""
    if abs(len(a) - len(b)) > limit:
        return limit + 1
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        if min(row) > limit:
            return limit + 1
    return min(row[-1], limit + 1)


def shift(reference: str, seen: str) -> int:
    """Places by which what follows is moved: how far the last piece of the alignment lies apart in the two."""
    last = SequenceMatcher(None, reference, seen).get_opcodes()[-1]
    return last[1] - last[3]


def nearest(piece: str, references: list[str], limit: int) -> tuple[int, int, int] | None:
    """Place (from 1), distance and shift of the only nearest reference within the limit; None on ties and for two at distance 1."""
    best, at, tie = limit + 1, 0, False
    for k, r in enumerate(references, 1):
        d = distance(piece, r, best)
        if d < best:
            best, at, tie = d, k, False
        elif d == best and d <= limit:
            tie = True
            if d == 1:
                return None
    if best > limit or tie:
        return None
    return at, best, shift(references[at - 1], piece)


class Annotator:
    """Finds labels with errors; keeps what it found for a piece."""

    def __init__(self, scheme: LabelScheme):
        self.scheme = scheme
        self.judged = scheme.judged
        self.exact = [{w: k for k, w in reversed([*enumerate(ws, 1)])} for ws in self.judged]
        s = SECTION_STARTS[scheme.version]
        self.starts = [s[0], s[2], s[4], s[5], s[6], s[7]]
        self.plain = [(s[0], s[1]), (s[2], s[3]), (s[4], s[5])]
        self.own = [{w: k for k, w in reversed([*enumerate(ws, 1)])} for ws in scheme.sections]
        self.found: dict[tuple[int, str], tuple[int, int, int] | None] = {}

    def __call__(self, seq: str) -> tuple[str, str, str, str]:
        """Label (``x`` for a section without a call), mismatches, UMI and what follows it."""
        label: list[str] = [str(t[seq[a:b]]) if seq[a:b] in t else "x" for t, (a, b) in zip(self.own, self.plain)]
        starts, miss = list(self.starts), ["0", "0", "0"]
        if "x" in label:
            for i in range(max(label.index("x") - 1, 0), 3):
                piece = seq[starts[i] : starts[i + 1]]
                if piece in self.exact[i]:
                    label[i] = str(self.exact[i][piece])
                    continue
                key = (i, piece)
                if key not in self.found:
                    self.found[key] = nearest(piece, self.judged[i], LIMITS[i])
                hit = self.found[key]
                if hit is None:
                    label[i] = miss[i] = "x"
                    break
                label[i], miss[i] = str(hit[0]), str(hit[1])
                starts[i + 1 :] = [x - hit[2] for x in starts[i + 1 :]]
        return "-".join(label), "-".join(miss), seq[starts[3] : starts[4]], seq[starts[4] :]


def annotate_labels(reads: DataFrame, scheme: LabelScheme, read_id: str = "read_id", seq: str = "seq") -> DataFrame:
    """``read_id, cell_label, mismatches, umi, poly_t``.

    Reads whose three sections are in the whitelists, nearly all, are looked up in literal maps and never leave the JVM. The others
    go to Python in Arrow batches: the first section without a match, the one before it and all after it are compared by edit distance, and
    an insertion or deletion moves the places of what follows. Null reads are left out.
    """
    ship(reads.sparkSession)
    s = SECTION_STARTS[scheme.version]
    r = reads.select(F.col(read_id).alias("read_id"), F.col(seq).alias("seq")).filter("seq IS NOT NULL")
    place = [whitelist_index(F.substring("seq", a + 1, b - a), w) for w, (a, b) in zip(scheme.sections, [(s[0], s[1]), (s[2], s[3]), (s[4], s[5])])]
    looked = r.select("read_id", "seq", *[p.alias(f"p{i}") for i, p in enumerate(place)])
    known = F.col("p0").isNotNull() & F.col("p1").isNotNull() & F.col("p2").isNotNull()
    exact = looked.filter(known).select("read_id", F.concat_ws("-", "p0", "p1", "p2").alias("cell_label"), F.lit("0-0-0").alias("mismatches"), F.substring("seq", s[5] + 1, s[6] - s[5]).alias("umi"), F.substring("seq", s[6] + 1, 1 << 20).alias("poly_t"))
    kind = dict(r.dtypes)["read_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Annotator(scheme)
        for b in batches:
            rows = [find(x) for x in b.column(1).to_pylist()]
            columns = zip(*rows) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, pa.string()) for c in columns)], names=["read_id", "cell_label", "mismatches", "umi", "poly_t"])

    rest = looked.filter(~known).select("read_id", "seq").mapInArrow(run, f"read_id {kind}, cell_label string, mismatches string, umi string, poly_t string")
    return exact.unionByName(rest)
