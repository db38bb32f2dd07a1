"""Scalar rules as Column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def strand_sign(code: Column) -> Column:
    """Aligner strand codes 0, 1, 2 as ?, + and -."""
    return F.translate(code.cast("string"), "012", "?+-")


def motif_sides(motif: Column) -> tuple[Column, Column]:
    """The two halves of a motif such as GT-AG, in upper case."""
    return F.upper(F.split_part(motif, F.lit("-"), F.lit(1))), F.upper(F.split_part(motif, F.lit("-"), F.lit(2)))


def pack_samples(entries: Column, sample: str = "sample", cov: str = "cov") -> Column:
    """An array of (sample, cov) as ,sample:cov,sample:cov."""
    return F.array_join(F.transform(entries, lambda e: F.concat(F.lit(","), e[sample].cast("string"), F.lit(":"), e[cov].cast("string"))), "")


def unpack_samples(packed: Column) -> Column:
    """The reverse: an array of (sample, cov) from a packed string with a leading comma; samples are texts."""
    parts = F.filter(F.split(packed, ","), lambda p: p != "")
    return F.transform(parts, lambda p: F.struct(F.split_part(p, F.lit(":"), F.lit(1)).alias("sample"), F.split_part(p, F.lit(":"), F.lit(2)).cast("long").alias("cov")))


def count_value(text: Column) -> Column:
    """A count written plainly or in scientific notation."""
    return F.coalesce(text.try_cast("long"), text.try_cast("double").cast("long"))


def strip_decimals(text: Column) -> Column:
    return F.regexp_replace(text, r"\.\d+$", "")


def low_order(text: Column, n: int = 2) -> Column:
    """The last characters, by which studies and runs are grouped."""
    return F.right(text, F.lit(n))


def trim_decorations(accession: Column, decorations: Sequence[str]) -> Column:
    """Drop each decoration once from either end."""
    for d in decorations:
        quoted = r"\Q" + d + r"\E"
        accession = F.regexp_replace(accession, f"^{quoted}|{quoted}$", "")
    return accession


def accession_bits(accession: Column, archive: str = "^[SED]RR") -> Column:
    """Twelve binary digits from an accession's end.

    Archive runs give four bits for each of the last three digits; other names
    six bits for each of the last two letters or digits, the top bit dropped.
    """
    digits = F.transform(F.split(F.right(accession, F.lit(3)), ""), lambda c: F.lpad(F.bin(c.try_cast("long")), 4, "0"))
    letters = F.transform(F.split(F.right(F.regexp_replace(accession, "[^A-Za-z0-9]", ""), F.lit(2)), ""), lambda c: F.lpad(F.substr(F.bin(F.ascii(c)), F.lit(2)), 6, "0"))
    return F.when(accession.rlike(archive), F.array_join(digits, "")).otherwise(F.array_join(letters, ""))


def leading_bits(accession: Column, archive: str = "^[SED]RR", decorations: Sequence[str] = ()) -> Column:
    """Twelve binary digits from an accession's beginning, as accession_bits has them from its end.

    Archive runs give the first three digits, other names the first two letters
    or digits, after decorations at either end are dropped.
    """
    name = trim_decorations(accession, decorations)
    digits = F.transform(F.split(F.substr(name, F.lit(4), F.lit(3)), ""), lambda c: F.lpad(F.bin(c.try_cast("long")), 4, "0"))
    letters = F.transform(F.split(F.left(F.regexp_replace(name, "[^A-Za-z0-9]", ""), F.lit(2)), ""), lambda c: F.lpad(F.substr(F.bin(F.ascii(c)), F.lit(2)), 6, "0"))
    return F.when(name.rlike(archive), F.array_join(digits, "")).otherwise(F.array_join(letters, ""))


def source_bit(accession: Column) -> Column:
    """0 for a name of one part, as archives give, 1 for one of several."""
    return F.when(F.size(F.split(accession, r"\W+|_")) == 1, "0").otherwise("1")


def source_and_transcript(tag: Column) -> tuple[Column, Column]:
    """The two halves of source:::transcript."""
    return F.split_part(tag, F.lit(":::"), F.lit(1)), F.split_part(tag, F.lit(":::"), F.lit(2))


def bits_to_long(*bits: Column) -> Column:
    return F.conv(F.concat(*bits), 2, 10).cast("long")


def one_based_key(chrom: Column, start: Column, end: Column, strand: Column) -> Column:
    """A half-open interval as chrom|start|end|strand, counted from one."""
    return F.concat_ws("|", chrom, (start + 1).cast("string"), end.cast("string"), strand)


def gene_and_annotation(name: Column, annotations: Sequence[str], spikes: str = "^(SIRV|ERCC)") -> tuple[Column, Column]:
    """A dotted gene name without its first part that is a known annotation, and that annotation."""
    parts = F.split(name, r"\.")
    known = F.filter(parts, lambda p: p.isin(*annotations))
    at = F.array_position(parts, known[0])
    spike = F.regexp_extract(name, spikes, 1)
    has = F.size(known) > 0
    gene = F.when(has, F.array_join(F.filter(parts, lambda p, i: i != at.cast("int") - 1), ".")).otherwise(name)
    return gene, F.when(has, known[0]).when(spike != "", spike)


def last_annotation(name: Column, annotations: Sequence[str]) -> Column:
    """The rightmost dotted part that is a known annotation; spike-ins by their first four characters."""
    found = F.filter(F.reverse(F.split(name, r"\.")), lambda p: p.isin(*annotations))
    return F.coalesce(F.when(F.size(found) > 0, found[0]), F.when(F.left(name, F.lit(4)).isin("ERCC", "SIRV"), F.left(name, F.lit(4))))


def digit_mask(counts: Column, width: int = 3) -> Column:
    """Counts as digits of fixed width, one group after another."""
    return F.array_join(F.transform(counts, lambda c: F.lpad(c.cast("string"), width, "0")), "")


def mask_counts(mask: Column, width: int = 3) -> Column:
    """The counts back from a digit mask."""
    n = F.floor(F.length(mask) / width).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substr(mask, i * width + 1, F.lit(width)).cast("int"))).otherwise(F.array().cast("array<int>"))


def gtf_attributes(text: Column) -> Column:
    """k "v"; k "v"; as a map."""
    pairs = F.regexp_extract_all(text, F.lit(r'(\w+ "[^"]*")'), F.lit(1))
    entries = F.transform(pairs, lambda p: F.struct(F.split_part(p, F.lit(" "), F.lit(1)).alias("key"), F.split_part(p, F.lit('"'), F.lit(2)).alias("value")))
    first = F.filter(entries, lambda e, i: F.array_position(F.transform(entries, lambda x: x["key"]), e["key"]) == i + 1)
    return F.map_from_entries(first)


def gtf_attribute(text: Column, key: str) -> Column:
    """gtf_attributes()[key] behind a quotation mark, '' if there is none; pairs before it are passed over whole, with what they quote."""
    return F.regexp_extract(text, rf'(?s)^(?:(?!\w+ "[^"]*").|(?!{key} ")\w+ "[^"]*")*+{key} ("[^"]*)"', 1)


def gene_pred_introns(starts: Column, ends: Column) -> Column:
    """Introns between comma-listed exons: one past an exon's end to the next one's start."""
    numbers = lambda c: F.transform(F.filter(F.split(c, ","), lambda x: x != ""), lambda x: x.cast("long"))
    s, e = numbers(starts), numbers(ends)
    pairs = F.arrays_zip(F.slice(e, F.lit(1), F.greatest(F.size(e) - 1, F.lit(0))).alias("left"), F.slice(s, F.lit(2), F.greatest(F.size(s) - 1, F.lit(0))).alias("right"))
    return F.transform(pairs, lambda p: F.struct((p["left"] + 1).alias("start"), p["right"].alias("end")))


def column_name(name: str) -> str:
    """Header text as a column name."""
    return name.strip().lower().replace("\n", " ").replace(" ", "_")


def file_parts(path: Column) -> tuple[Column, Column, Column]:
    """sample, study and reference of a path like .../sample!study!reference!..."""
    name = F.regexp_extract(path, r"([^/]+)$", 1)
    return tuple(F.split_part(name, F.lit("!"), F.lit(i)) for i in (1, 2, 3))


def attempt_number(path: Column) -> Column:
    return F.regexp_extract(path, r"_att(?:empt)?(\d+)", 1).try_cast("int")


def check_project(project: str) -> tuple[str, int]:
    """name:id with 100 <= id < 250, or an error."""
    name, _, number = project.partition(":")
    if not name or not number.isdigit() or not 100 <= int(number) < 250:
        raise ValueError(f"a project is name:id with an id from 100 to 249, not {project!r}")
    return name, int(number)
