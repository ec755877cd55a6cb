"""Per-read expressions: qualities, slices, checks and classes. All are JVM-side columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BASES = "ACTGN"
PHRED_OFFSET = 33

# ---------------------------------------------------------------- statistics of a read


def mean_quality(qual: Column) -> Column:
    """Mean Phred score; null for an empty string."""
    scores = F.aggregate(F.filter(F.split(qual, ""), lambda c: c != ""), F.lit(0), lambda a, c: a + F.ascii(c) - PHRED_OFFSET)
    return F.try_divide(scores, F.length(qual))


def count_of(seq: Column, letter: str) -> Column:
    return F.length(seq) - F.length(F.replace(seq, F.lit(letter), F.lit("")))


def top_base_share(seq: Column) -> Column:
    """Share of the most frequent of A, C, T, G, N; null for an empty read."""
    return F.try_divide(F.greatest(*[count_of(seq, b) for b in BASES]), F.length(seq))


def quality_checks(r1: Column, q1: Column, r2: Column, q2: Column, min_r1: int = 60, min_r2: int = 42, min_quality: float = 20, max_r1: float = 0.55, max_r2: float = 0.80, judged: int = 75) -> dict[str, Column]:
    """``length``, ``quality`` and ``base`` failures of a pair; R1 is judged by its first ``judged`` bases."""
    s1, p1 = F.substring(r1, 1, judged), F.substring(q1, 1, judged)
    return {
        "fails_length": (F.length(s1) < min_r1) | (F.length(r2) < min_r2),
        "fails_quality": (mean_quality(p1) < min_quality) | (mean_quality(q2) < min_quality),
        "fails_base": (top_base_share(s1) >= max_r1) | (top_base_share(r2) >= max_r2),
    }


# ---------------------------------------------------------------- slices of R1

# Where sections, linkers, the UMI and the poly-T begin (from 0), by label version.
SECTION_STARTS = {1: (0, 8, 20, 28, 40, 48, 56, 64), 2: (0, 9, 21, 30, 43, 52, 60, 68)}


def label_slices(seq: Column, version: int) -> dict[str, Column]:
    """The three label sections, the UMI and the poly-T region."""
    s = SECTION_STARTS[version]
    cut = lambda a, b: F.substring(seq, a + 1, b - a)
    return {"section_1": cut(s[0], s[1]), "section_2": cut(s[2], s[3]), "section_3": cut(s[4], s[5]), "umi": cut(s[5], s[6]), "poly_t": F.substring(seq, s[6] + 1, 1 << 20)}


def poly_t_passes(region: Column, window: int = 8, least: int = 6, needed: int = 7) -> Column:
    """At least ``least`` T in the first ``window`` bases; a region shorter than ``needed`` isn't judged."""
    return F.when(F.length(region) >= needed, count_of(F.substring(region, 1, window), "T") >= least).otherwise(F.lit(True))


def plate_poly_t_passes(seq: Column) -> Column:
    """Plate reads: more than 10 T among the 15 bases after the 16th."""
    return count_of(F.substring(seq, 17, 15), "T") > 10


def whitelist_index(section: Column, whitelist: list[str]) -> Column:
    """1-based place in a whitelist of fixed size, or null: a literal map, so no join."""
    pairs = [x for i, w in enumerate(whitelist, 1) for x in (F.lit(w), F.lit(i))]
    return F.element_at(F.create_map(*pairs), section)


_PARITY = {1: (1, 3, 5, 7), 2: (2, 3, 6, 7), 4: (4, 5, 6, 7), 8: (1, 2, 3, 4, 5, 6, 7, 8)}


def repair_checksum(code: Column) -> Column:
    """A base-4 code of seven places and an overall parity, one substitution repaired.

    Each check sums the places whose number has its bit, modulo 4; the failing checks name the place,
    the largest remainder is the error. Codes with letters other than A, C, G, T, or of another length, are null.
    """
    value = lambda i: F.position(F.substring(code, i, 1), F.lit("ACGT")) - 1
    checks = {bit: sum((value(i) for i in places[1:]), value(places[0])) % 4 for bit, places in _PARITY.items()}
    size = F.greatest(*checks.values())
    place = sum((F.when(checks[b] > 0, b).otherwise(0) for b in (1, 2, 4)), F.lit(0))
    at = F.when(place == 0, 8).otherwise(place)
    wrong = F.position(F.substr(code, at, F.lit(1)), F.lit("ACGT")) - 1
    right = F.substr(F.lit("ACGT"), F.pmod(wrong - size, F.lit(4)) + 1, F.lit(1))
    fixed = F.concat(F.substr(code, F.lit(1), at - 1), right, F.substr(code, at + 1, F.lit(8)))
    return F.when(code.rlike("^[ACGT]{8}$"), F.when(size == 0, code).otherwise(fixed))


# ---------------------------------------------------------------- R2 and alignments

# Kinds of reference, by the end of its name, with the least aligned length and the last allowed start.
KINDS = {"stAbO": ("tag", 40, 29), "pAbO": ("protein", 25, 15), "VDJ": ("receptor", None, None)}
MRNA_LENGTH, MRNA_START = 37, 5
# Fixed value: what marks a protein in a plain gene name.
PROTEIN_MARK = " (AbSeq)"


def reference_kind(name: Column) -> Column:
    """``tag``, ``protein``, ``receptor`` or ``mRNA`` by the end of a reference name."""
    kind = F.lit("mRNA")
    for suffix, (k, _, _) in KINDS.items():
        kind = F.when(F.endswith(name, F.lit(suffix)), k).otherwise(kind)
    return F.when(name.isNotNull(), kind)


def matched_length(cigar: Column) -> Column:
    """Sum of the lengths of a CIGAR's M operations; 0 if it has none."""
    return F.aggregate(F.regexp_extract_all(cigar, F.lit("([0-9]+)M"), F.lit(1)), F.lit(0), lambda a, x: a + x.cast("int"))


def length_passes(kind: Column, matched: Column) -> Column:
    out = matched >= MRNA_LENGTH
    for k, length, _ in KINDS.values():
        out = F.when(kind == k, F.lit(True) if length is None else matched >= length).otherwise(out)
    return out


def start_passes(kind: Column, position: Column) -> Column:
    out = (position > 0) & (position <= MRNA_START)
    for k, _, last in KINDS.values():
        out = F.when(kind == k, F.lit(True) if last is None else (position > 0) & (position <= last)).otherwise(out)
    return out


def older_start_passes(kind: Column, position: Column) -> Column:
    """The start rule of tables read again from alignments: positions 1 to 5, protein and tag as ``start_passes``."""
    return F.when(kind == "mRNA", position.between(1, 5)).otherwise(start_passes(kind, position))


def older_length_passes(kind: Column, matched: Column) -> Column:
    """The length rule of tables read again from alignments: more than 60, tags from 40, proteins from 30."""
    return F.when(kind == "tag", matched >= 40).when(kind == "protein", matched >= 30).when(kind == "receptor", True).otherwise(matched > 60)


def umi_is_valid(umi: Column) -> Column:
    """Not empty, no N, and a length of 0 or 8 modulo 12."""
    return F.coalesce((F.length(umi) > 0) & ~umi.contains("N") & (F.length(umi) % 12).isin(0, 8), F.lit(False))


def r1_is_valid(label: Column, poly_t: Column, umi: Column) -> Column:
    return F.coalesce(~label.contains("x") & poly_t & umi_is_valid(umi), F.lit(False))


def r2_is_valid(start: Column, length: Column, is_control: Column) -> Column:
    """Both checks hold; null (a skipped check) doesn't. Control reads are never valid."""
    return F.coalesce(start & length, F.lit(False)) & ~F.coalesce(is_control, F.lit(False))


def alignment_type(status: Column) -> Column:
    """``mapped``, ``not_unique``, ``ambiguous``, ``not_aligned`` or ``no_feature`` from an assignment's status."""
    return (
        F.when((status == "1") | status.contains("MAcorrected"), "mapped")
        .when(F.startswith(status, F.lit("alignment")), "not_unique")
        .when(F.startswith(status, F.lit("ambiguous")), "ambiguous")
        .when(status == "x", "not_aligned")
        .otherwise("no_feature")
    )


def protein_umi(seq: Column) -> Column:
    return F.substring(seq, 1, 12)


def control_distance(length: Column, position: Column) -> Column:
    """Distance of an alignment's start from the 3' end of a control of known length."""
    return length - position


# ---------------------------------------------------------------- names


def plain_gene_name(name: Column) -> Column:
    """The symbol of a panel entry; a protein entry says so: ``CD3:1|CD3|pAbO`` is ``CD3`` and ``PROTEIN_MARK``."""
    symbol = F.substring_index(F.substring_index(name, "|", 1), ":", 1)
    return F.when(F.endswith(name, F.lit("pAbO")), F.concat(symbol, F.lit(PROTEIN_MARK))).otherwise(symbol)


def ratio(text: Column) -> Column:
    """``a/b`` as a number; null if it isn't one or b is 0."""
    return F.try_divide(F.split_part(text, F.lit("/"), F.lit(1)).try_cast("double"), F.split_part(text, F.lit("/"), F.lit(2)).try_cast("double"))


def separate(text: Column, delimiter: str, names: list[str]) -> list[Column]:
    """One column into several, by a literal delimiter; missing pieces are null."""
    pieces = F.split(text, "\\Q" + delimiter + "\\E")
    return [F.try_element_at(pieces, F.lit(i)).alias(n) for i, n in enumerate(names, 1)]


def recode(col: Column, mapping: dict, otherwise: Column | None = None) -> Column:
    """Values replaced by a literal mapping; others stay, or become ``otherwise``."""
    pairs = [x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))]
    return F.coalesce(F.element_at(F.create_map(*pairs), col), col if otherwise is None else otherwise)


def finite(x: Column, fill: float = 0.0) -> Column:
    """NaN, infinite and null become ``fill``."""
    return F.when(x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")), F.lit(fill)).otherwise(x)
