"""Quality figures from logs: long (sample, key, value) rows, then ratios by name."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def metrics(logs: DataFrame, patterns: Mapping[str, str], text: str = "text") -> DataFrame:
    """For each log and named pattern, every value found, as (…, key, value).

    Later values of a key get a number behind it: key, key2, key3.
    """
    keep = [c for c in logs.columns if c != text]
    found = F.map_from_arrays(F.array(*map(F.lit, patterns)), F.array(*(F.regexp_extract_all(F.col(text), F.lit(p), F.lit(1)) for p in patterns.values())))
    each = logs.select(*keep, F.explode(found).alias("key", "_v")).select(*keep, "key", F.posexplode("_v").alias("_i", "value"))
    return each.withColumn("key", F.when(F.col("_i") > 0, F.concat("key", (F.col("_i") + 1).cast("string"))).otherwise(F.col("key"))).drop("_i")


def _number(text: Column) -> Column:
    """The number that a text begins with, spaces and what follows aside."""
    return F.regexp_extract(F.ltrim(text), r"^[0-9]+(\.[0-9]+)?", 0).try_cast("double")


def _field(line: Column, i: int, by: str = "\t") -> Column:
    return F.get(F.split(line, by), F.lit(i))


#: Name and value of a line of each kind of log; both are null in lines that hold none.
LINES: dict[str, Callable[[Column], tuple[Column, Column]]] = {
    # the aligner: name |<tab>value, of which dates and texts count nothing
    "star": lambda t: (F.trim(F.substring_index(t, "|", 1)), _number(_field(t, 1, r"\|\t"))),
    # reads by sequence: name, length, mapped, unmapped; * stands for those without a place
    "idxstats": lambda t: (F.when(~t.startswith("*"), _field(t, 0)), _number(_field(t, 2))),
    # covered bases: name and value
    "bc_auc": lambda t: (F.when(F.size(F.split(t, "\t")) == 2, _field(t, 0)), _number(_field(t, 1))),
    # fragment lengths: the word STAT, name and value
    "bc_frag": lambda t: (F.when(_field(t, 0) == "STAT", _field(t, 1)), _number(_field(t, 2))),
    # a feature counter: reads looked at, and those that some feature got, after a colon
    "counter": lambda t: (F.when(t.contains("Successfully assigned"), "assigned").when(t.contains("Total "), "total"), _number(F.substring_index(t, ":", -1))),
}


def _numbered(each: DataFrame, keep: Sequence[str], kind: str) -> DataFrame:
    """Rows (…, _i, _k, value) with keys kind.name, and a number behind a name that comes again, in order."""
    n = F.row_number().over(Window.partitionBy(*keep, "_k").orderBy("_i"))
    key = F.concat(F.lit(f"{kind}."), F.regexp_replace("_k", " ", "_"))
    return each.withColumn("_n", n).select(*keep, F.when(F.col("_n") > 1, F.concat(key, F.col("_n").cast("string"))).otherwise(key).alias("key"), "value")


def log_lines(logs: DataFrame, kind: str, text: str = "text", name: str | None = None) -> DataFrame:
    """(…, key, value) of every line of a kind of log, in order: key is the kind, or the name given, and the line's name with underscores.

    A name that comes again is name2, name3, as where an aligner ran twice.
    """
    keep = [c for c in logs.columns if c != text]
    each = logs.select(*keep, F.posexplode(F.split(text, "\r?\n")).alias("_i", "_t"))
    label, value = LINES[kind](F.col("_t"))
    found = each.select(*keep, "_i", label.alias("_k"), value.alias("value")).where("_k <> '' and value is not null")
    return _numbered(found, keep, name or kind)


def counter_lines(logs: DataFrame, name: str, text: str = "text") -> DataFrame:
    """(…, key, value) of a feature counter's log: total and assigned reads."""
    return log_lines(logs, "counter", text, name)


def read_quality(logs: DataFrame, text: str = "text") -> DataFrame:
    """(…, key, value) of a read-quality table: mean quality and error quality over all positions, of the first reads and, as avgQ2 and errQ2, of their mates.

    The line ALL has, after it, the bases, five shares of letters, and these two.
    """
    keep = [c for c in logs.columns if c != text]
    each = logs.select(*keep, F.posexplode(F.split(text, "\r?\n")).alias("_i", "_t")).where("_t rlike '^ALL[ \t]'")
    cells = F.array(*(F.struct(F.lit(k).alias("k"), _number(_field(F.col("_t"), i, "[ \t]+")).alias("v")) for k, i in (("avgQ", 7), ("errQ", 8))))
    found = each.select(*keep, "_i", F.explode(cells).alias("c")).select(*keep, "_i", F.col("c.k").alias("_k"), F.col("c.v").alias("value")).where("value is not null")
    return _numbered(found, keep, "seqtk")


#: Ratios of the report: name, part, whole. Fixed values.
RATIOS = (
    ("bc_auc.all_percent", "bc_auc.ALL_READS_ANNOTATED_BASES", "bc_auc.ALL_READS_ALL_BASES"),
    ("bc_auc.unique_percent", "bc_auc.UNIQUE_READS_ANNOTATED_BASES", "bc_auc.UNIQUE_READS_ALL_BASES"),
    ("gene_fc.all_percent", "gene_fc_count_all.assigned", "star.All_mapped_reads"),
    ("gene_fc.unique_percent", "gene_fc_count_unique.assigned", "star.Uniquely_mapped_reads_number"),
    ("exon_fc.all_percent", "exon_fc_count_all.assigned", "star.All_mapped_reads"),
    ("exon_fc.unique_percent", "exon_fc_count_unique.assigned", "star.Uniquely_mapped_reads_number"),
)


def report(long: DataFrame, key: Sequence[str] = ("study", "sample"), ratios: Sequence[tuple[str, str, str]] = RATIOS, chromosomes: Sequence[str] = ("chrM", "chrX", "chrY")) -> DataFrame:
    """One row for each sample from (…, key, value) rows: all reads mapped, the ratios, and chromosomes' shares of mapped reads.

    A missing figure counts as 0 and a ratio to nothing is 0; a chromosome's
    share is -1 where nothing is mapped or the chromosome isn't listed.
    """
    one, many = "star.Uniquely_mapped_reads_number", "star.Number_of_reads_mapped_to_multiple_loci"
    names = sorted({one, many, *(x for _, a, b in ratios for x in (a, b) if x != "star.All_mapped_reads")})
    figures = {n: F.max(F.when(F.col("key") == n, F.col("value"))) for n in names}
    shares = {c: F.max(F.when(F.col("key") == f"idxstats.{c}", F.col("value"))) for c in chromosomes}
    wide = long.groupBy(*key).agg(*(F.coalesce(v, F.lit(0.0)).alias(n) for n, v in figures.items()), *(v.alias(c) for c, v in shares.items()), F.sum(F.when(F.col("key").startswith("idxstats."), F.col("value"))).alias("_mapped"))
    col = lambda n: F.col(f"`{n}`") if n != "star.All_mapped_reads" else col(one) + col(many)
    ratio = [F.when(col(b) != 0, F.round(100 * col(a) / col(b), 2)).otherwise(F.lit(0.0)).alias(n) for n, a, b in ratios]
    share = [percent(F.col(c), F.col("_mapped")).alias(f"idxstats.{c}_percent") for c in chromosomes]
    return wide.select(*key, *(col(n) for n in names), col("star.All_mapped_reads").alias("star.All_mapped_reads"), *ratio, *share)


def condensed_report(rows: DataFrame, key: Sequence[str], counts: Sequence[str], input_reads: str, mapped: str, bases: str, length: str) -> DataFrame:
    """A few figures of each sample: each count with that of a second run added, both input counts as a:b, and whole percentages.

    A second run's columns end in 2. all_reads_mapped is the share of input
    reads that are mapped, all_bases_mapped that of the input's bases.
    """
    two = lambda n: F.coalesce(F.col(f"`{n}`"), F.lit(0)) + F.coalesce(F.col(f"`{n}2`"), F.lit(0))
    both = F.concat_ws(":", F.coalesce(F.col(f"`{input_reads}`"), F.lit(0)).cast("string"), F.coalesce(F.col(f"`{input_reads}2`"), F.lit(0)).cast("string"))
    total = sum((F.coalesce(F.col(f"`{input_reads}{x}`"), F.lit(0)) * F.coalesce(F.col(f"`{length}{x}`"), F.lit(0)) for x in ("", "2")), F.lit(0))
    share = lambda part, whole: F.when(whole > 0, F.round(100.0 * part / whole)).otherwise(F.lit(0.0)).cast("long")
    return rows.select(*key, share(two(mapped), two(input_reads)).alias("all_reads_mapped"), share(F.col(f"`{bases}`"), total).alias("all_bases_mapped"), *(two(n).alias(n) for n in counts), both.alias("both_input_reads"), total.alias("all_bases"))


def percent(part: Column, whole: Column, places: int = 2, missing: float = -1.0) -> Column:
    return F.when(whole.isNull() | part.isNull() | (whole == 0), F.lit(missing)).otherwise(F.round(100.0 * part / whole, places))


def table(long: DataFrame, key: Sequence[str], names: Sequence[str]) -> DataFrame:
    """One row for each sample and one column for each metric, sorted by name."""
    return long.groupBy(*key).pivot("key", sorted(names)).agg(F.max("value"))


def chromosome_shares(idxstats: DataFrame, key: Sequence[str], chromosomes: Sequence[str] = ("chrM", "chrX", "chrY")) -> DataFrame:
    """Share of mapped reads on some chromosomes, -1.0 where nothing is known."""
    total = F.sum("mapped")
    return idxstats.groupBy(*key).agg(*(percent(F.sum(F.when(F.col("chrom") == c, F.col("mapped")).otherwise(0)), total).alias(f"{c}_percent") for c in chromosomes))


def both_ends(rows: DataFrame, names: Sequence[str], total: str) -> DataFrame:
    """For each metric the sum of its first and second value, and its percentage of a total to one place, 0 without input."""
    out = rows
    for n in names:
        both = F.coalesce(F.col(n), F.lit(0)) + F.coalesce(F.col(f"{n}2"), F.lit(0))
        out = out.withColumn(f"{n}_both", both).withColumn(f"{n}_both_percent", F.when(F.coalesce(F.col(total), F.lit(0)) > 0, F.round(100.0 * both / F.col(total), 1)).otherwise(F.lit(0.0)))
    return out


def run_times(rules: DataFrame, rule: str = "rule", seconds: str = "seconds") -> DataFrame:
    """Seconds of each rule, its share of all, and the least and most."""
    each = rules.groupBy(rule).agg(F.sum(seconds).alias("total"), F.min(seconds).alias("least"), F.max(seconds).alias("most"))
    return each.withColumn("percent", percent(F.col("total"), F.sum("total").over(Window.partitionBy(F.lit(0)))))  # one row for each rule
