"""Data checks. Each returns the violating rows; no rows means the check passes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidewatt import schemas
from tidewatt.functions.calendar import month_spine
from tidewatt.operators.joins import missing_from
from tidewatt.operators.reshape import unpivot_periods
from tidewatt.sources import lines
from tidewatt.sources.lines import BAD_ROW
from tidewatt.sources.seeds import KNOWN_FUEL_CODES

# ---- column rules ----------------------------------------------------------------------------


def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; incomplete keys are the not-null check's business."""
    return (
        df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    )


def orphans(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Non-null references without a parent row, one row per value."""
    refs = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return refs.join(parent.select(F.col(parent_column).alias(column)), column, "left_anti")


def unexpected_values(df: DataFrame, column: str, accepted: Sequence) -> DataFrame:
    return df.filter(F.col(column).isNotNull() & ~F.col(column).isin(*accepted)).groupBy(column).agg(
        F.count(F.lit(1)).alias("n")
    )


def out_of_range(df: DataFrame, column: str, low=None, high=None) -> DataFrame:
    bad = F.lit(False)
    if low is not None:
        bad = bad | (F.col(column) < low)
    if high is not None:
        bad = bad | (F.col(column) > high)
    return df.filter(bad)


# ---- reconciliation --------------------------------------------------------------------------


def _side_by_side(left: DataFrame, right: DataFrame, measure: Column, a: str, b: str) -> DataFrame:
    """Two totals in one row: scalar subqueries, no join."""
    one = left.agg(measure.alias(a))
    return one.withColumn(b, right.agg(measure).scalar())


def count_mismatch(
    source: DataFrame, fact: DataFrame, keys: Sequence[str], a: str = "raw_rows", b: str = "fct_rows"
) -> DataFrame:
    """Distinct complete source keys against fact rows; no keys compares plain row counts."""
    grain = source.dropna(subset=list(keys)).select(*keys).distinct() if keys else source
    both = _side_by_side(grain, fact, F.count(F.lit(1)), a, b)
    return both.withColumn("diff_rows", F.col(a) - F.col(b)).filter(F.col(a) != F.col(b))


def sum_mismatch(
    left: DataFrame, right: DataFrame, a: str, b: str, tolerance: float = 0.0, keys: Sequence[str] = ()
) -> DataFrame:
    """Totals of left.a and right.b that differ by more than the tolerance, overall or per key."""
    if keys:
        x = left.groupBy(*keys).agg(F.sum(a).alias("left_total"))
        y = right.groupBy(*keys).agg(F.sum(b).alias("right_total"))
        both = x.join(y, list(keys))
    else:
        both = left.agg(F.sum(a).alias("left_total")).withColumn("right_total", right.agg(F.sum(b)).scalar())
    diff = F.abs(F.col("left_total") - F.col("right_total"))
    return both.withColumn("diff", diff).filter(F.col("diff") > tolerance)


def low_match_rate(fact: DataFrame, dim: DataFrame, key: str, minimum: float = 0.80) -> DataFrame:
    """Share of the fact's distinct keys the dimension knows, if below the minimum."""
    return match_rate(fact, dim, key).filter(F.col("match_rate") < minimum)


def match_rate(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    known = dim.select(key).distinct().withColumn("_hit", F.lit(1))
    keys = fact.select(key).distinct().join(known, key, "left")
    matched, total = F.count("_hit"), F.count(F.lit(1))
    return keys.agg(
        matched.alias("matched"), total.alias("total"),
        F.when(total > 0, matched.cast("double") / total).alias("match_rate"),
    )


def missing_periods(spark: SparkSession, loaded: DataFrame, period: str, first: str, last: str) -> DataFrame:
    """Months of the range that were never loaded."""
    return missing_from(month_spine(spark, first, last, period), loaded.select(period).distinct(), [period])


def rows_per_period(df: DataFrame, period: str, low: int = 5000, high: int = 300000) -> DataFrame:
    counts = df.groupBy(period).agg(F.count(F.lit(1)).alias("row_count"))
    return counts.filter((F.col("row_count") < low) | (F.col("row_count") > high))


def null_ratio(audit: DataFrame, rows: DataFrame, limit: float = 0.001) -> DataFrame:
    """Unexpected empty cells against typed rows, if above the limit."""
    both = _side_by_side(audit, rows, F.count(F.lit(1)), "null_count", "total_count")
    pct = F.col("null_count").cast("double") * 100.0 / F.nullif(F.col("total_count").cast("double"), F.lit(0.0))
    over = F.col("null_count") > F.col("total_count").cast("double") * limit
    return both.withColumn("null_pct", F.round(pct, 4)).filter(over)


def freshness(df: DataFrame, loaded_at: str, as_of: date, warn_days: int = 35, error_days: int = 45) -> DataFrame:
    """Age of the newest load with its verdict: pass, warn or error."""
    age = F.datediff(F.lit(as_of), F.col("newest").cast("date"))
    newest = df.agg(F.max(loaded_at).alias("newest")).withColumn("age_days", age)
    verdict = (
        F.when(F.col("age_days").isNull() | (F.col("age_days") > error_days), "error")
        .when(F.col("age_days") > warn_days, "warn")
        .otherwise("pass")
    )
    return newest.withColumn("status", verdict)


# ---- checks as data --------------------------------------------------------------------------


@dataclass(frozen=True)
class Check:
    """A check of its own plan: rows that violate it."""

    name: str
    violations: DataFrame
    severity: str = "error"

    def counts(self) -> DataFrame:
        found = self.violations.agg(F.count(F.lit(1)).alias("violations"))
        return found.select(F.lit(self.name).alias("check"), F.lit(self.severity).alias("severity"), "violations")


@dataclass(frozen=True)
class Rule:
    """A condition of bad rows; a null condition is no violation."""

    name: str
    bad: Column
    severity: str = "error"


def not_null_rule(columns: Sequence[str], name: str = "not_null", severity: str = "error") -> Rule:
    bad = F.lit(False)
    for c in columns:
        bad = bad | F.col(c).isNull()
    return Rule(name, bad, severity)


def accepted_rule(column: str, accepted: Sequence, severity: str = "error") -> Rule:
    return Rule(f"accepted_{column}", ~F.col(column).isin(*accepted), severity)


def range_rule(column: str, low=None, high=None, severity: str = "error") -> Rule:
    return Rule(f"range_{column}", _outside(column, low, high), severity)


@dataclass(frozen=True)
class Key:
    """Columns that must be unique together; incomplete keys are the not-null rule's business."""

    name: str
    columns: Sequence[str]
    severity: str = "error"


@dataclass(frozen=True)
class TableRules:
    """All rules on the rows of one table as one vector of counts, and its keys; the table is scanned once."""

    table: str
    df: DataFrame
    rules: Sequence[Rule] = ()
    keys: Sequence[Key] = ()

    def _vector(self) -> list[Column]:
        return [F.count_if(r.bad).alias(f"_r{i}") for i, r in enumerate(self.rules)]

    def _report(self, totals: DataFrame) -> DataFrame:
        entries = [(r, f"_r{i}") for i, r in enumerate(self.rules)] + [(k, f"_u{i}") for i, k in enumerate(self.keys)]
        rows = F.array(*[F.struct(F.lit(f"{self.table}.{x.name}").alias("check"), F.lit(x.severity).alias("severity"),
                                  F.coalesce(c, F.lit(0)).cast("long").alias("violations")) for x, c in entries])
        return totals.select(F.inline(rows))

    def counts(self) -> DataFrame:
        """(check, severity, violations). Where there are keys, the vector is summed per key on the way: one shuffle for all."""
        if not self.keys:
            return self._report(self.df.agg(*self._vector()))
        sums = [F.sum(f"_r{i}").alias(f"_r{i}") for i in range(len(self.rules))]
        if len(self.keys) == 1:
            columns = list(self.keys[0].columns)
            whole = F.lit(True)
            for c in columns:
                whole = whole & F.col(c).isNotNull()
            groups = self.df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"), *self._vector())
            return self._report(groups.agg(*sums, F.count_if(whole & (F.col("_n") > 1)).alias("_u0")))
        # Several keys: a row is dealt once per key, and carries the vector with the first one.
        dealt = F.array(*[F.struct(F.lit(i).alias("_i"), F.when(self._complete(k), F.to_json(F.struct(*k.columns))).alias("_key"))
                          for i, k in enumerate(self.keys)])
        flags = [F.coalesce(r.bad, F.lit(False)).alias(f"_b{i}") for i, r in enumerate(self.rules)]
        rows = self.df.select(*flags, F.inline(dealt))
        groups = rows.groupBy("_i", "_key").agg(F.count(F.lit(1)).alias("_n"), *[
            F.count_if(F.col(f"_b{i}") & (F.col("_i") == 0)).alias(f"_r{i}") for i in range(len(self.rules))])
        twice = F.col("_key").isNotNull() & (F.col("_n") > 1)
        return self._report(groups.agg(*sums, *[F.count_if(twice & (F.col("_i") == i)).alias(f"_u{i}") for i in range(len(self.keys))]))

    @staticmethod
    def _complete(key: Key) -> Column:
        whole = F.lit(True)
        for c in key.columns:
            whole = whole & F.col(c).isNotNull()
        return whole

    def written(self, write) -> DataFrame:
        """Run write(df) and return the counts of the rules, observed while the rows passed: no scan of its own.

        Keys need a shuffle, so they are left to counts().
        """
        seen = Observation()
        write(self.df.observe(seen, *(self._vector() or [F.count(F.lit(1)).alias("_rows")])))
        values = seen.get
        rows = [(f"{self.table}.{r.name}", r.severity, int(values[f"_r{i}"])) for i, r in enumerate(self.rules)]
        return self.df.sparkSession.createDataFrame(rows, "check string, severity string, violations long")


def run_checks(spark: SparkSession, checks: Sequence[Check | TableRules]) -> DataFrame:
    """One row per check: violations and status, computed in one job."""
    return with_status(reduce(DataFrame.unionByName, [c.counts() for c in checks]))


def with_status(counts: DataFrame) -> DataFrame:
    bad = F.when(F.col("severity") == "warn", "warn").otherwise("fail")
    return counts.withColumn("status", F.when(F.col("violations") == 0, "pass").otherwise(bad))


# ---- file contracts --------------------------------------------------------------------------

_NUMBER = r"^\s*[+-]?(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)([eE][+-]?\d+)?\s*$|^\s*[+-]?(?i:inf|infinity|nan)\s*$"
_INTEGER = r"^\s*[+-]?\d+(_\d+)*\s*$"


def _text(c: str) -> Column:
    return F.coalesce(c, F.lit(""))


def _no_number(c: str) -> Column:
    return ~_text(c).rlike(_NUMBER)


def _no_number_or_null(c: str) -> Column:
    t = _text(c)
    return (F.trim(t) != "") & (F.upper(F.trim(t)) != "NULL") & ~t.rlike(_NUMBER)


# Cells that are plainly numbers, empty or null, each ended by a bar; a bar inside a cell makes one more, which does not match.
_PLAIN_CELLS = r"^(?:(?:[0-9]++\.?+[0-9]*+|NULL|null)?+\|){%d}$" % schemas.PERIODS


def _doubtful_cells() -> Column:
    """Whether the cells of a line have to be looked at one by one."""
    cells = [x for i in range(1, schemas.PERIODS + 1) for x in (_text(f"tp{i}"), F.lit("|"))]
    return ~F.concat(*cells).rlike(_PLAIN_CELLS)


def _no_period(c: str) -> Column:
    t = _text(c)
    number = F.when(t.rlike(_INTEGER), F.replace(F.trim(t), F.lit("_"), F.lit("")).try_cast("int"))
    return ~F.coalesce(number.between(1, 50), F.lit(False))


def _no_integer(c: str) -> Column:
    return ~_text(c).rlike(_INTEGER)


def _no_date(c: str, second_dash: bool) -> Column:
    t = _text(c)
    ok = (F.length(t) == 10) & (F.substring(t, 5, 1) == "-")
    return ~(ok & (F.substring(t, 8, 1) == "-")) if second_dash else ~ok


def _other_month(c: str, tag: str) -> Column:
    return F.replace(F.substring(_text(c), 1, 7), F.lit("-"), F.lit("")) != F.col(tag)


@dataclass(frozen=True)
class Contract:
    """What a published file must look like; a rule is (name, column, condition of a bad row)."""

    columns: dict[str, str]
    rules: Sequence[tuple[str, str, Column]]
    min_rows: int
    max_rows: int | None = None
    min_bytes: int | None = None
    max_bytes: int | None = None
    cells: bool = False  # the wide period cells must be numbers or empty


def price_contract() -> Contract:
    return Contract(
        schemas.PRICE,
        [
            ("trading_date", "trading_date", _no_date("trading_date", False)),
            ("month", "trading_date", _other_month("trading_date", "period")),
            ("trading_period", "trading_period", _no_period("trading_period")),
            ("price", "dollars_per_mwh", _no_number_or_null("dollars_per_mwh")),
        ],
        min_rows=100,
    )


def volume_contract() -> Contract:
    return Contract(
        schemas.VOLUME,
        [
            ("poc", "point_of_connection", _text("point_of_connection") == ""),
            ("island", "island", ~_text("island").isin("NI", "SI")),
            ("trading_date", "trading_date", _no_date("trading_date", True)),
            ("month", "trading_date", _other_month("trading_date", "period")),
            ("trading_period", "trading_period", _no_period("trading_period")),
            ("flow", "flow_direction", ~_text("flow_direction").isin("Injection", "Offtake")),
            ("kwh", "kilowatt_hours", _no_number("kilowatt_hours")),
        ],
        min_rows=100,
    )


def offers_contract() -> Contract:
    day = F.concat_ws(
        "-", F.substring("period", 1, 4), F.substring("period", 5, 2), F.substring("period", 7, 2)
    )
    energy = (_text("product_type") == "Energy") & (_text("product_class") == "Injection")
    return Contract(
        schemas.OFFERS,
        [
            ("trading_date", "trading_date", _text("trading_date") != day),
            ("participant", "participant_code", _text("participant_code") == ""),
            ("poc", "point_of_connection", _text("point_of_connection") == ""),
            ("product_type", "product_type", _text("product_type") == ""),
            ("product_class", "product_class", _text("product_class") == ""),
            ("unit", "unit", energy & (_text("unit") == "")),
            ("submission_date", "utc_submission_date", _no_date("utc_submission_date", True)),
            ("trading_period", "trading_period", _no_period("trading_period")),
            ("submission_order", "submission_order", _no_integer("submission_order")),
            ("is_latest", "is_latest_yes_no", ~_text("is_latest_yes_no").isin("Y", "N")),
            ("tranche", "tranche", _no_integer("tranche")),
            ("megawatts", "megawatts", _no_number("megawatts")),
            ("price", "dollars_per_mwh", _no_number("dollars_per_mwh")),
        ],
        min_rows=20,
    )


def generation_contract() -> Contract:
    return Contract(
        schemas.GENERATION,
        [
            ("trading_date", "trading_date", _no_date("trading_date", False)),
            ("month", "trading_date", _other_month("trading_date", "period")),
            ("fuel_code", "fuel_code", ~_text("fuel_code").isin(*KNOWN_FUEL_CODES)),
        ],
        min_rows=100,
        max_rows=50_000,
        min_bytes=1024,
        max_bytes=10 * 1024 * 1024,
        cells=True,
    )


def row_violations(rows: DataFrame, contract: Contract, ids: Sequence[str] = ("file_name",)) -> DataFrame:
    """(ids, rule, value) per bad row of an all-text frame that carries `period`.

    Every rule is one pass-through CASE over the row: no rule adds a scan.
    """
    found = F.array_compact(
        F.array(*[
            F.when(bad, F.struct(F.lit(name).alias("rule"), F.col(column).alias("value")))
            for name, column, bad in contract.rules
        ])
    )
    out = rows.select(*ids, F.explode(found).alias("_f")).select(*ids, "_f.rule", "_f.value")
    if not contract.cells:
        return out
    cells = unpivot_periods(rows, list(ids), value="value").filter(_no_number_or_null("value"))
    rule = F.concat(F.lit("tp"), F.col("tp_number").cast("string"))
    return out.unionByName(cells.select(*ids, rule.alias("rule"), "value"))


def _contract_lines(spark: SparkSession, path: str, contract: Contract, file_name: str) -> DataFrame:
    """Parsed lines with the period of their file, and whether a line is the expected header."""
    rows = lines.parsed(lines.scan_lines(spark, path), list(contract.columns.values()))
    is_header = F.lit(True)
    for source, target in contract.columns.items():
        is_header = is_header & F.col(target).eqNullSafe(F.lit(source))
    part = "file_name" if file_name.startswith("^") else "file_path"
    rows = rows.withColumn("period", F.regexp_extract(part, file_name, 1)).withColumn("_header", is_header & F.col(BAD_ROW).isNull())
    return rows.withColumn("_doubtful", _doubtful_cells()) if contract.cells else rows


def _row_rules(contract: Contract) -> list[tuple[str, Column, Column]]:
    """(rule, condition of a bad line, value), for lines that are no header."""
    body = ~F.col("_header")
    whole = body & F.col(BAD_ROW).isNull()
    found = [("columns", body & F.col(BAD_ROW).isNotNull(), F.col(BAD_ROW))]
    found += [(name, whole & bad, F.col(column)) for name, column, bad in contract.rules]
    if contract.cells:
        found += [(f"tp{i}", whole & F.col("_doubtful") & _no_number_or_null(f"tp{i}"), F.col(f"tp{i}")) for i in range(1, schemas.PERIODS + 1)]
    return found


def _limits(contract: Contract) -> list[tuple[str, Column, Column]]:
    """(rule, condition of a bad file, value) over the counts of a file."""
    return [
        ("file_name", F.col("period") == "", F.element_at(F.split("file_path", "/"), -1)),
        ("header", (F.col("_headers") != 1) | ~F.coalesce(F.col("_head.line") == 1, F.lit(False)), F.col("_headers")),
        ("row_count", _outside("_rows", contract.min_rows, contract.max_rows), F.col("_rows")),
        ("file_size", _outside("file_size", contract.min_bytes, contract.max_bytes), F.col("file_size")),
    ]


def file_report(spark: SparkSession, path: str, contract: Contract, file_name: str) -> DataFrame:
    """(file_name, period, rule, violations, line, value) of the files under `path`: how often each rule is broken,
    and the first line that does, by its number in the file; for a rule on the whole file line is null.

    One scan and one aggregate per file, whatever the number of rules and of bad lines. A file must have the expected
    header as its first line and nowhere else, every other line the right number of columns, and the file an expected
    number of lines and bytes. A file without any line is not seen. file_name is searched in the name of a file if it
    begins with ^, else in its path; its first group is the period.
    """
    tags = ["period", "file_size"]
    rules = lines.per_file(
        _contract_lines(spark, path, contract, file_name), *tags, kind=F.when(F.col("_header"), "_headers").otherwise("_rows"),
        firsts={n: (bad, value) for n, bad, value in _row_rules(contract)})
    header, row = F.col("rule") == "_headers", F.col("rule") == "_rows"
    # At most one entry per rule in a file's list.
    files = rules.groupBy("file_path", *tags).agg(
        F.coalesce(F.max(F.when(header, F.col("n"))), F.lit(0)).alias("_headers"),
        F.coalesce(F.max(F.when(row, F.col("n"))), F.lit(0)).alias("_rows"),
        F.struct(F.min(F.when(header, F.col("line"))).alias("line")).alias("_head"),
        F.collect_list(F.when(~header & ~row, F.struct("rule", F.col("n").alias("violations"), "line", "value"))).alias("_found"))
    whole = [F.when(bad, _finding(n, F.lit(1), F.lit(None), value)) for n, bad, value in _limits(contract)]
    name = F.element_at(F.split("file_path", "/"), -1).alias("file_name")
    return files.select(name, "period", F.explode(F.concat("_found", F.array_compact(F.array(*whole)))).alias("_f")).select(
        "file_name", "period", "_f.*")


def _finding(rule: str, violations: Column, line: Column, value: Column) -> Column:
    return F.struct(F.lit(rule).alias("rule"), violations.cast("long").alias("violations"), line.cast("long").alias("line"),
                    value.cast("string").alias("value"))


def check_files(spark: SparkSession, path: str, contract: Contract, file_name: str) -> DataFrame:
    """Every single violation of the files under `path`: (file_name, rule, value).

    For files of which file_report tells that they are bad; lists their lines by a second scan.
    """
    whole = file_report(spark, path, contract, file_name).filter("line is null")
    rows = _contract_lines(spark, path, contract, file_name)
    found = [F.when(bad, F.struct(F.lit(n).alias("rule"), value.alias("value"))) for n, bad, value in _row_rules(contract)]
    rows = rows.select("file_name", F.explode(F.array_compact(F.array(*found))).alias("_f")).select("file_name", "_f.*")
    return whole.select("file_name", "rule", "value").unionByName(rows)


def _outside(column: str, low, high) -> Column:
    bad = F.lit(False)
    if low is not None:
        bad = bad | (F.col(column) < low)
    if high is not None:
        bad = bad | (F.col(column) > high)
    return bad
