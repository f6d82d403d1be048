"""All rules of one table: flags, summary and detail with as few passes as possible.

* Rules that look at one row only share one scan: the summary is one wide
  aggregate, the detail one filtered projection.  Rows are never repeated per rule.
* Rules that look at groups or reference tables first reduce the table to its
  failing keys (partial aggregation before every shuffle).  All such rules share
  one scan and one shuffle (``operators.key_reduction``).  The failing keys are
  stored once and serve both summary and detail.
* Rules that change the number of rows run on their own branch.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..conditions import leaves, plain_fields
from ..functions import keys as K
from ..functions.national_id import national_id_messages
from ..functions.predicates import holds_or_false, messages
from ..functions.text import is_missing, lookup_key, missing_message, named, text_columns
from ..operators import groups, key_reduction, references, reshape
from ..operators.joins import ROWS, SizeLimit, join_keyed
from ..operators.storage import release, stored
from ..rules import Rule

YEAR, BATCH = "__year", "__batch"
SLICES = [YEAR, BATCH]
RULE = key_reduction.RULE
WHOLE = ("tinyint", "smallint", "int", "bigint")
#: Key rules that share one scan.
KEY_RULES_PER_PASS = 12

# Types whose text is never blank and never the word NULL.
NEVER_BLANK = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal", "boolean", "date", "timestamp")

# The flag codes (-2 is reserved and never produced).
MISSING, PASS, VIOLATION = -1, 0, 1

SUMMARY_COLUMNS = (
    "unique_key", "object", "attribute_name", "dimension", "rule_id", "rule_type", "system", "sub_system", "domain",
    "applied_rule", "rule_description", "total_record_count", "no_of_complete_records", "total_passed_count",
    "no_of_failures", "value", "year_id", "batch_id", "rule_run_date",
)
DETAIL_COLUMNS = (
    "unique_key", "rule_id", "dimension", "object", "attribute_name", "year_id", "batch_id", "rule_run_date",
    "system", "sub_system", "domain", "rule_type", "applied_rule", "rule_description", "rule_json", "category",
    "critical_attribute", "model_integrity", "source_table_attributes", "result", "rule_violation_details", "value",
    "key_columns", "values_of_key_columns", "key1", "value1", "key2", "value2", "key3", "value3", "key4", "value4",
)


class TableCheck:
    """Evaluates a list of rules over one table (or the slice of it that ``df`` holds)."""

    def __init__(
        self,
        df: DataFrame,
        rules: Sequence[Rule],
        run_date: str,
        batch_id: int | None = None,
        year_id: int | None = None,
        tables: Mapping[str, DataFrame] | Callable[[str], DataFrame] | None = None,
        limit: SizeLimit | None = None,
        rules_per_pass: int = 30,
        lower_key_values: bool = False,
    ):
        self.spark = df.sparkSession
        self.columns = list(df.columns)
        self.run_date = run_date
        self.limit = limit or SizeLimit()
        self.rules_per_pass = rules_per_pass
        self.lower_key_values = lower_key_values
        self._tables = tables
        self._failing: dict = {}
        self._paths: list[str] = []
        self._fixed: dict[str, Column] = {}
        self._nulls = {
            name.lower(): f"__null_{i}" for i, (name, kind) in enumerate(df.dtypes) if kind.startswith(NEVER_BLANK)
        }
        self._typed = {
            name.lower(): (f"__exact_{i}", "bigint" if kind in WHOLE else kind)
            for i, (name, kind) in enumerate(df.dtypes)
            if kind in WHOLE or kind == "double" or kind.startswith("decimal")
        }
        self.rows = self._with_slices(self._text_view(df), batch_id, year_id)
        self.rules = [self._resolved(rule) for rule in rules]

    # -- results ---------------------------------------------------------------

    def flags(self, rule: Rule) -> DataFrame:
        """Every row with ``rule_violation_flag`` and ``rule_violation_details`` for one rule."""
        flagged = self._flagged(self._resolved(rule))
        return flagged.select(
            *[named(c) for c in self.columns], "rule_violation_flag", "rule_violation_details"
        )

    def summary(self, lakehouse_layer: str | None = None) -> DataFrame:
        """One row per rule, year and batch with counts and the pass rate."""
        self._share_key_rules()
        parts = [self._local_counts(chunk) for chunk in self._chunks()]
        for index, rule in enumerate(self.rules):
            if rule.reshapes_rows:
                parts.append(self._flag_counts(index, rule))
            elif not rule.is_row_local:
                parts.append(self._group_fail_counts(index, rule))
        counts = reduce(DataFrame.unionByName, parts)
        if len(parts) > 1:
            counts = counts.groupBy(RULE, *SLICES).agg(*[F.sum(c).alias(c) for c in ("total", "missing", "failed")])
        passed = F.col("total") - F.col("missing") - F.col("failed")
        joined = counts.join(F.broadcast(self._about_rules()), RULE)
        shaped = joined.select(
            "*",
            F.col(YEAR).alias("year_id"),
            F.col(BATCH).alias("batch_id"),
            F.lit(self.run_date).alias("rule_run_date"),
            F.col("total").alias("total_record_count"),
            (F.col("total") - F.col("missing")).alias("no_of_complete_records"),
            passed.alias("total_passed_count"),
            (F.col("missing") + F.col("failed")).alias("no_of_failures"),
            (passed / F.col("total")).alias("value"),
        )
        return self._finished(shaped, SUMMARY_COLUMNS, lakehouse_layer)

    def detail(self, lakehouse_layer: str | None = None) -> DataFrame:
        """One row per record and rule it fails, with the record's image and keys."""
        self._share_key_rules()
        parts, left = [], self.limit
        for chunk in self._chunks():
            rows, settled = self.rows, {}
            for index, rule in chunk:
                if self._one_lookup(rule):
                    keys, verdicts = self._verdicts(rule)
                    rest = left.after(verdicts)
                    if rest is None:
                        parts.append(self._group_failures(index, rule, keys, verdicts))
                    else:
                        left = rest
                        rows = self._with_verdict(rows, index, keys, verdicts)
                        settled[index] = F.col(f"__n{index}").isNotNull()
                elif not rule.is_row_local:
                    parts.append(self._flag_failures(index, rule))
            parts.append(self._shared_failures(chunk, rows, settled))
        parts += [self._flag_failures(i, rule) for i, rule in enumerate(self.rules) if rule.reshapes_rows]
        failures = reduce(DataFrame.unionByName, parts)
        joined = failures.join(F.broadcast(self._about_rules()), RULE)
        image, extra = F.col("source_table_attributes"), F.col("extra")
        body = F.expr("left(source_table_attributes, length(source_table_attributes) - 1)")
        whole = F.when(extra.isNull(), image).otherwise(F.concat(body, F.lit(","), extra, F.lit("}")))
        shaped = joined.withColumns(
            {
                "year_id": F.col(YEAR),
                "batch_id": F.col(BATCH),
                "rule_run_date": F.lit(self.run_date),
                "source_table_attributes": whole,
            }
        )
        return self._finished(shaped, DETAIL_COLUMNS, lakehouse_layer)

    def release(self) -> None:
        """Delete the stored key sets, once every result of this check has been written."""
        release(self.spark, self._paths)
        self._failing.clear()

    # -- shared pieces -----------------------------------------------------------

    def _text_view(self, df: DataFrame) -> DataFrame:
        """The table as text.  Beside it stand the NULL test of typed columns, whose text is never blank, and numbers
        in their own type, which comparisons, sums and keys use; what no rule reads is never computed.
        """
        tests = [named(name).isNull().alias(hidden) for name, hidden in self._nulls.items()]
        exact = [named(name).cast(kind).alias(hidden) for name, (hidden, kind) in self._typed.items()]
        return df.select(*text_columns(df), *tests, *exact)

    def _missing(self, columns: Sequence[str]) -> Column:
        """Any of the columns is missing; typed columns need no look at their text."""
        tests = []
        for name in columns:
            hidden = self._nulls.get(name.lower())
            tests.append(is_missing(named(name)) if hidden is None else F.coalesce(F.col(hidden), F.lit(True)))
        return reduce(lambda a, b: a | b, tests)

    def _with_slices(self, text: DataFrame, batch_id: int | None, year_id: int | None) -> DataFrame:
        """Adds year and batch: given ones hold for all rows, else they come from the table's columns."""
        names = {c.lower() for c in text.columns}
        for slot, given, column in ((YEAR, year_id, "year_id"), (BATCH, batch_id, "load_date")):
            if given is not None or column not in names:
                self._fixed[slot] = F.lit(given).cast("int")
        year = self._fixed.get(YEAR, named("year_id").try_cast("int"))
        return text.withColumns({YEAR: year, BATCH: self._fixed.get(BATCH, named("load_date").try_cast("int"))})

    @property
    def _varying(self) -> list[str]:
        """Slices that differ between rows; fixed ones stay out of grouping keys."""
        return [name for name in SLICES if name not in self._fixed]

    def _resolved(self, rule: Rule) -> Rule:
        return rule.bind(columns=tuple(self.columns)) if "*" in rule.columns else rule

    def table(self, name: str) -> DataFrame:
        if callable(self._tables):
            return self._tables(name)
        if self._tables and name in self._tables:
            return self._tables[name]
        return self.spark.table(name)

    def _chunks(self) -> list[list[tuple[int, Rule]]]:
        """Rules that share a pass: everything but the row-changing ones, in bounded groups.

        Ordered by column, so that further passes mostly read other columns.
        """
        shared = [(i, r) for i, r in enumerate(self.rules) if not r.reshapes_rows]
        shared.sort(key=lambda pair: [c.lower() for c in pair[1].columns])
        return [shared[i : i + self.rules_per_pass] for i in range(0, len(shared), self.rules_per_pass)]

    def _selected(self, rule: Rule) -> Column | None:
        """The rows a later stage looks at, or the violation itself when there is no later stage."""
        if rule.violation is None:
            return None
        chosen = self._holds(rule, rule.violation)
        return chosen if rule.national_id is None else self._bad_id(rule) | chosen

    def _bad_id(self, rule: Rule) -> Column:
        return F.concat_ws("", *self._id_messages(rule)) != ""

    def _local_violation(self, rule: Rule) -> Column | None:
        """Violation decided by the row alone; None when the rule only checks for missing values."""
        if not rule.is_row_local:
            return None
        having = None if rule.having is None else self._holds(rule, rule.having)
        return self._combined(rule, having, None)

    def _combined(self, rule: Rule, having: Column | None, absent: Column | None) -> Column | None:
        """A violation condition selects what later stages must confirm; without one, any stage flags."""
        later = [test for test in (having, absent) if test is not None]
        selected = self._selected(rule)
        if selected is not None:
            return reduce(lambda a, b: a & b, [selected, *later])
        if rule.national_id is not None:
            later.insert(0, self._bad_id(rule))
        return reduce(lambda a, b: a | b, later) if later else None

    def _local_messages(self, rule: Rule) -> list[Column]:
        found = self._id_messages(rule) if rule.national_id is not None else []
        return found + self._texts(rule, rule.violation) + self._texts(rule, rule.having)

    def _holds(self, rule: Rule, condition) -> Column:
        return holds_or_false(condition, dict(rule.thresholds), self._typed_beside(rule))

    def _texts(self, rule: Rule, condition) -> list[Column]:
        return messages(condition, dict(rule.thresholds), self._typed_beside(rule))

    def _typed_beside(self, rule: Rule) -> dict[str, tuple[str, str]]:
        """Typed columns a rule's conditions may use: an aggregate of the same name hides the column."""
        made = {c.alias.lower() for spec in rule.aggregations for c in spec.calculations}
        return {name: kind for name, kind in self._typed.items() if name not in made}

    def _id_messages(self, rule: Rule) -> list[Column]:
        spec = rule.national_id
        return national_id_messages(rule.columns[0], spec.current_year, spec.dob_column)

    def _details(self, rule: Rule, missing: Column, violated: Column | None, found: list[Column]) -> Column:
        text = F.when(missing, missing_message(rule.columns))
        if violated is not None:
            text = text.when(violated, F.concat_ws(", ", *found))
        return text.otherwise(F.lit(""))

    @staticmethod
    def _flag(missing: Column, violated: Column | None) -> Column:
        flag = F.when(missing, F.lit(MISSING))
        if violated is not None:
            flag = flag.when(violated, F.lit(VIOLATION))
        return flag.otherwise(F.lit(PASS))

    # -- one row at a time -------------------------------------------------------

    def local_aggregates(self, chunk) -> tuple[list[Column], list[Column]]:
        """Aggregates of the rules' missing and failed rows, and the structs that list them per rule."""
        aggregates, entries = [], []
        for index, rule in chunk:
            missing, violated = self._missing(rule.columns), self._local_violation(rule)
            aggregates.append(F.count_if(missing).alias(f"m{index}"))
            failed = F.lit(0).cast("long")
            if violated is not None:
                aggregates.append(F.count_if(~missing & violated).alias(f"f{index}"))
                failed = F.col(f"f{index}")
            entry = (F.lit(index).alias(RULE), F.col(f"m{index}").alias("missing"), failed.alias("failed"))
            entries.append(F.struct(*entry))
        return aggregates, entries

    def local_counts_of_row(self, chunk) -> list[Column]:
        """The structs of ``local_aggregates`` for a single row."""
        entries = []
        for index, rule in chunk:
            missing, violated = self._missing(rule.columns), self._local_violation(rule)
            failed = F.lit(False) if violated is None else F.coalesce(~missing & violated, F.lit(False))
            entry = (missing.cast("long").alias("missing"), failed.cast("long").alias("failed"))
            entries.append(F.struct(F.lit(index).alias(RULE), *entry))
        return entries

    def _local_counts(self, chunk) -> DataFrame:
        aggregates, entries = self.local_aggregates(chunk)
        wide = self.rows.groupBy(*self._varying).agg(F.count(F.lit(1)).alias("total"), *aggregates)
        if not self._varying:
            wide = wide.where(F.col("total") > 0)
        return wide.withColumns(self._fixed).select(*SLICES, "total", F.inline(F.array(*entries))).select(
            RULE, *SLICES, "total", "missing", "failed"
        )

    def _failure(self, index: int, rule: Rule, result: Column, details: Column, extra: Column) -> Column:
        """One failed rule of a row; ``extra`` is JSON text of aggregates to append to the record image."""
        values = [
            K.key_value_at(rule.composite_columns, i, self.lower_key_values).alias(f"value{i + 1}")
            for i in range(K.UNPACKED_KEYS)
        ]
        return F.struct(
            F.lit(index).alias(RULE),
            result.alias("result"),
            details.alias("rule_violation_details"),
            K.attribute_values(rule.columns).alias("value"),
            K.key_values(rule.composite_columns).alias("values_of_key_columns"),
            *values,
            extra.cast("string").alias("extra"),
        )

    def _shared_failures(self, chunk, rows: DataFrame, settled: dict[int, Column]) -> DataFrame:
        """One pass for many rules: failing rows list the rules they fail, then the list is unrolled.

        ``settled`` holds, per rule decided by keys, the column that tells whether
        the row's key fails; its missing values are found here in any case.

        Clean rows are dropped by compiled code.  For the others the list is built
        by a higher-order function: it is evaluated expression by expression,
        where one compiled method for it would be too large for the JIT compiler
        and several times slower.  Both steps unroll with ``explode_outer``
        because the optimizer would push a plain filter below the text view and
        cast every column again for each test.
        """
        tests, entries = [], []
        for index, rule in chunk:
            missing, violated = self._missing(rule.columns), self._local_violation(rule)
            found, extra = self._local_messages(rule) if rule.is_row_local else [], F.lit(None)
            if index in settled:
                selected = self._selected(rule)
                violated = settled[index] if selected is None else settled[index] & selected
                found = self._texts(rule, rule.violation) + [F.col(f"__text{index}")]
                extra = F.col(f"__extra{index}")
            if rule.aggregations:
                extra = F.when(missing, F.lit(zero_aggregates(rule))).otherwise(extra)
            fails = missing if violated is None else missing | violated
            details = self._details(rule, missing, violated, found)
            tests.append(fails)
            failure = self._failure(index, rule, self._flag(missing, violated), details, extra)
            entries.append(F.when(fails, failure))
        any_fails = reduce(lambda a, b: a | b, tests)
        marked = rows.select("*", F.explode_outer(F.when(any_fails, F.array(F.lit(True)))).alias("__fails"))
        failing = marked.where(F.col("__fails").isNotNull())
        hits = F.filter(F.array(*entries), lambda hit: hit.isNotNull()).alias("__hits")
        imaged = failing.select(*SLICES, K.record_image(self.columns).alias("source_table_attributes"), hits)
        unrolled = imaged.select(*SLICES, "source_table_attributes", F.explode_outer("__hits").alias("__hit"))
        return unrolled.where(F.col("__hit").isNotNull()).select(*SLICES, "source_table_attributes", "__hit.*")

    # -- groups and references ---------------------------------------------------

    @staticmethod
    def _keys_decide(rule: Rule) -> bool:
        """Each later stage is settled by the row's keys alone, so failing keys are enough."""
        if not rule.aggregations:
            return bool(rule.references) and rule.having is None
        if len(rule.aggregations) > 1 or rule.having is None or not rule.aggregations[0].group_by:
            return False
        aliases = {c.alias.lower() for c in rule.aggregations[0].calculations}
        used = plain_fields(rule.having)
        return used is not None and used <= aliases

    def _one_lookup(self, rule: Rule) -> bool:
        """The rows a rule flags are exactly the applicable rows of one set of failing keys."""
        if rule.reshapes_rows or rule.national_id is not None or not self._keys_decide(rule):
            return False
        return len(rule.aggregations) + len(rule.references) == 1

    def _applicable(self, rows: DataFrame, rule: Rule) -> DataFrame:
        rows = rows.where(~self._missing(rule.columns))
        return rows if rule.violation is None else rows.where(self._selected(rule))

    def _group_keys(self, group_by, digest: bool) -> list[tuple[str, Column]]:
        """Type and value of each grouping column: whole numbers as such, digests as bytes, the rest as text."""
        keys = []
        for name in group_by:
            hidden, kind = self._typed.get(name.lower(), ("", ""))
            if digest:
                keys.append(("binary", F.unhex(F.sha2(named(name), 256))))
            else:
                keys.append(("bigint", F.col(hidden)) if kind == "bigint" else ("string", named(name)))
        return keys

    def _reference_keys(self, rule: Rule, reference) -> list[tuple[str, Column]]:
        """As for groups; numbers only where the table and its reference both hold whole numbers."""
        kinds = {name.lower(): kind for name, kind in self.table(reference.table).dtypes}
        keys = []
        for column, other in zip(rule.columns, reference.columns):
            hidden, kind = self._typed.get(column.lower(), ("", ""))
            if kind == "bigint" and kinds.get(other.lower()) in WHOLE:
                keys.append(("bigint", F.col(hidden)))
            else:
                keys.append(("string", lookup_key(named(column))))
        return keys

    @staticmethod
    def _numbered(keys) -> dict[str, Column]:
        return {f"__k{i}": value for i, (_, value) in enumerate(keys)}

    @staticmethod
    def _memo(rule: Rule) -> str | None:
        """What a rule's lookups depend on; None where they depend on more than the table's own rows."""
        if rule.reshapes_rows:
            return None
        stages = (rule.columns, rule.violation, rule.national_id, rule.aggregations, rule.having)
        return repr((*stages, rule.references, rule.thresholds))

    def _shareable(self, rule: Rule) -> bool:
        if not self._one_lookup(rule):
            return False
        return all(key_reduction.shareable(spec.calculations, bool(self._varying)) for spec in rule.aggregations)

    def _key_task(self, number: int, rule: Rule) -> key_reduction.KeyTask:
        applicable = ~self._missing(rule.columns)
        if rule.violation is not None:
            applicable = applicable & self._selected(rule)
        thresholds = tuple(rule.thresholds)
        if rule.aggregations:
            (spec,) = rule.aggregations
            keys = tuple(self._group_keys(spec.group_by, spec.digest))
            return key_reduction.KeyTask(number, keys, applicable, spec.calculations, rule.having, thresholds)
        (reference,) = rule.references
        keys = tuple(self._reference_keys(rule, reference))
        names, kinds = [f"__k{i}" for i in range(len(keys))], [kind for kind, _ in keys]
        allowed = references.allowed_rows(self.table(reference.table), reference, names, kinds)
        return key_reduction.KeyTask(number, keys, applicable, allowed=allowed, thresholds=thresholds)

    def _share_key_rules(self) -> None:
        """Settle all rules decided by one set of keys in one scan, if there are several that are not settled yet."""
        pending = {self._memo(r): r for r in self.rules if self._shareable(r)}
        pending = [(memo, rule) for memo, rule in pending.items() if memo not in self._failing]
        if len(pending) < 2:
            return
        for at in range(0, len(pending), KEY_RULES_PER_PASS):
            part = pending[at : at + KEY_RULES_PER_PASS]
            tasks = [self._key_task(i, rule) for i, (_, rule) in enumerate(part)]
            failing = key_reduction.failing_keys(self.rows, tasks, self._varying, self._typed).withColumns(self._fixed)
            kept = stored(failing, self._paths, [RULE])
            for task, (memo, rule) in zip(tasks, part):
                own = key_reduction.of_task(kept, task, SLICES)
                names = [c.alias for spec in rule.aggregations for c in spec.calculations]
                self._failing[memo] = [(self._numbered(task.keys), own, names)]

    def _lookups(self, rows: DataFrame, rule: Rule):
        """(keys, stored failing groups, aggregate names) of every later stage."""
        memo = self._memo(rule)
        if memo in self._failing:
            return self._failing[memo]
        found = []
        applicable, varying = self._applicable(rows, rule), self._varying
        for spec in rule.aggregations:
            keys = self._numbered(self._group_keys(spec.group_by, spec.digest))
            failing = groups.failing_groups(
                applicable, keys, varying, spec.calculations, rule.having, dict(rule.thresholds), self._typed
            )
            kept = stored(failing.withColumns(self._fixed), self._paths)
            found.append((keys, kept, [c.alias for c in spec.calculations]))
        for reference in rule.references:
            typed = self._reference_keys(rule, reference)
            keys, kinds = self._numbered(typed), [kind for kind, _ in typed]
            table = self.table(reference.table)
            failing = references.failing_groups(applicable, keys, varying, table, reference, kinds)
            found.append((keys, stored(failing.withColumns(self._fixed), self._paths), []))
        if memo is not None:
            self._failing[memo] = found
        return found

    def _group_fail_counts(self, index: int, rule: Rule) -> DataFrame:
        """Failed rows per slice, from the stored failing groups; totals come from the shared pass."""
        if self._one_lookup(rule):
            ((_, failing, _),) = self._lookups(self.rows, rule)
            failed = failing.groupBy(*SLICES).agg(F.sum(ROWS).alias("failed"))
        else:
            flagged = self._flagged(rule).where(F.col("rule_violation_flag") == VIOLATION)
            failed = flagged.groupBy(*SLICES).agg(F.count(F.lit(1)).alias("failed"))
        nothing = F.lit(0).cast("long")
        return failed.select(
            F.lit(index).alias(RULE), *SLICES, nothing.alias("total"), nothing.alias("missing"), "failed"
        )

    def _with_hits(self, rows: DataFrame, lookups) -> DataFrame:
        """Left joins of each lookup's failing keys; ``__hit{i}`` tells whether the row's key fails."""
        for i, (keys, failing, names) in enumerate(lookups):
            keyed = self._one_row_per_key(failing, keys, names)
            rows = join_keyed(rows, list(keys.values()), keyed, list(keys), self.limit, "left", self._paths)
            rows = rows.withColumn(f"__hit{i}", F.col(ROWS).isNotNull()).drop(ROWS, *keys)
        return rows

    def _one_row_per_key(self, failing: DataFrame, keys, names) -> DataFrame:
        """The slices of a key put together; where they are fixed, a key was stored as one row."""
        if not self._varying:
            return failing.select(*keys, ROWS, *[named(n) for n in names])
        facts = [F.first(named(n)).alias(n) for n in names]
        return failing.groupBy(*keys).agg(F.sum(ROWS).alias(ROWS), *facts)

    def _verdicts(self, rule: Rule) -> tuple[dict[str, Column], DataFrame]:
        """Failing keys, one row each, with ``__n``, the message and the aggregates as JSON text."""
        ((keys, failing, names),) = self._lookups(self.rows, rule)
        keyed = self._one_row_per_key(failing, keys, names)
        text = self._texts(rule, rule.having) or [F.lit(reference_message(rule))]
        extra = aggregates_text(names)
        facts = (F.concat_ws(", ", *text).alias("__text"), extra.alias("__extra"))
        return keys, keyed.select(*keys, ROWS, *facts)

    @staticmethod
    def _with_verdict(rows: DataFrame, index: int, keys: dict[str, Column], verdicts: DataFrame) -> DataFrame:
        """Rows with one rule's broadcast verdict beside them, under names of its own."""
        renamed = verdicts.select(*[F.col(c).alias(f"{c}{'_' if c in keys else ''}{index}") for c in verdicts.columns])
        wide = rows.withColumns({f"{k}_{index}": value for k, value in keys.items()})
        on = [f"{k}_{index}" for k in keys]
        return wide.join(F.broadcast(renamed), on, "left").drop(*on)

    def _group_failures(self, index: int, rule: Rule, keys: dict[str, Column], verdicts: DataFrame) -> DataFrame:
        """Violations of a rule whose failing keys are too many to broadcast."""
        applicable = self._applicable(self.rows, rule)
        hit = join_keyed(applicable, list(keys.values()), verdicts, list(keys), self.limit, "inner", self._paths)
        found = self._texts(rule, rule.violation) + [F.col("__text")]
        image = K.record_image(self.columns).alias("source_table_attributes")
        failure = self._failure(index, rule, F.lit(VIOLATION), F.concat_ws(", ", *found), F.col("__extra"))
        listed = hit.select(*SLICES, image, failure.alias("__hit"))
        return listed.select(*SLICES, "source_table_attributes", "__hit.*")

    # -- any rule, row by row ------------------------------------------------------

    def _flagged(self, rule: Rule) -> DataFrame:
        """Every row with its flag, details and aggregates: the general path for any mix of stages."""
        rows = self.rows
        if rule.enrich is not None:
            rows = reshape.enrich(rows, self.table(rule.enrich.table), rule.enrich, self.limit, self._paths)
        if rule.distinct:
            rows = reshape.distinct_rows(rows, self._distinct_columns(rule))
        found = self._local_messages(rule)
        if rule.aggregations and not self._keys_decide(rule):
            rows, having, absent = self._with_row_facts(rows, rule)
        else:
            rows, having, absent = self._with_lookups(rows, rule)
        violated = self._combined(rule, having, absent)
        if absent is not None:
            found.append(F.when(absent, F.lit(reference_message(rule))))
        missing = self._missing(rule.columns)
        return rows.withColumns(
            {
                "rule_violation_flag": self._flag(missing, violated),
                "rule_violation_details": self._details(rule, missing, violated, found),
            }
        )

    def _distinct_columns(self, rule: Rule) -> list[str]:
        """The rule's distinct columns with what stands beside them: equal texts have equal values, so the groups are
        the same, and a rule that reads no other column keeps no record.  Rows made by a join may lack what is beside.
        """
        if rule.enrich is not None:
            return list(rule.distinct_columns)
        beside = []
        for name in dict.fromkeys(c.lower() for c in rule.distinct_columns):
            beside += [self._nulls[name]] if name in self._nulls else []
            beside += [self._typed[name][0]] if name in self._typed else []
        return [*rule.distinct_columns, *beside]

    def _with_lookups(self, rows: DataFrame, rule: Rule):
        """Stages settled by failing keys: one left join each."""
        if not rule.aggregations and not rule.references:
            having = None if rule.having is None else self._holds(rule, rule.having)
            return rows, having, None
        lookups = self._lookups(rows, rule)
        rows = self._with_hits(rows, lookups)
        hits = [F.col(f"__hit{i}") for i in range(len(lookups))]
        having = hits.pop(0) if rule.aggregations else None
        return rows, having, self._any_of(hits)

    def _with_row_facts(self, rows: DataFrame, rule: Rule):
        """Stages whose condition reads row columns too: group facts are attached to every row."""
        for spec in rule.aggregations:
            rows = self._with_facts(rows, rule, spec)
        having = None if rule.having is None else self._holds(rule, rule.having)
        if not rule.references:
            return rows, having, None
        lookups = self._lookups(rows, rule.bind(aggregations=(), having=None))
        rows = self._with_hits(rows, lookups)
        return rows, having, self._any_of([F.col(f"__hit{i}") for i in range(len(lookups))])

    @staticmethod
    def _any_of(tests: Sequence[Column]) -> Column | None:
        return reduce(lambda a, b: a | b, tests) if tests else None

    def _with_facts(self, rows: DataFrame, rule: Rule, spec) -> DataFrame:
        applicable = self._applicable(rows, rule)
        thresholds = dict(rule.thresholds)
        if not spec.group_by:
            if any(groups.is_selected(c) for c in spec.calculations):
                facts = groups.group_facts(applicable, {"__whole": F.lit(1)}, spec.calculations, thresholds, self._typed)
                facts = stored(facts, self._paths)
                return rows.withColumns({c.alias: facts.select(named(c.alias)).scalar() for c in spec.calculations})
            whole = applicable.agg(*[groups.aggregate_column(c, thresholds, self._typed) for c in spec.calculations])
            return rows.withColumns(
                {c.alias: whole.select(named(c.alias)).scalar() for c in spec.calculations}
            )
        keys = self._numbered(self._group_keys(spec.group_by, spec.digest))
        facts = stored(groups.group_facts(applicable, keys, spec.calculations, thresholds, self._typed), self._paths)
        wide = join_keyed(rows, list(keys.values()), facts, list(keys), self.limit, "left", self._paths)
        return wide.drop(ROWS, *keys)

    def _flag_counts(self, index: int, rule: Rule) -> DataFrame:
        flag = F.col("rule_violation_flag")
        return (
            self._flagged(rule)
            .groupBy(*SLICES)
            .agg(
                F.count(F.lit(1)).alias("total"),
                F.count_if(flag == MISSING).alias("missing"),
                F.count_if(flag == VIOLATION).alias("failed"),
            )
            .select(F.lit(index).alias(RULE), *SLICES, "total", "missing", "failed")
        )

    def _flag_failures(self, index: int, rule: Rule) -> DataFrame:
        wanted = F.col("rule_violation_flag") != PASS
        if not rule.reshapes_rows:
            wanted = F.col("rule_violation_flag") == VIOLATION  # missing rows come from the shared pass
        failing = self._flagged(rule).where(wanted)
        names = [c.alias for spec in rule.aggregations for c in spec.calculations]
        image = K.record_image(self.columns).alias("source_table_attributes")
        flag, details = F.col("rule_violation_flag"), F.col("rule_violation_details")
        extra = F.when(flag == MISSING, F.lit(zero_aggregates(rule))).otherwise(aggregates_text(names))
        failure = self._failure(index, rule, flag, details, extra)
        listed = failing.select(*SLICES, image, failure.alias("__hit"))
        return listed.select(*SLICES, "source_table_attributes", "__hit.*")

    # -- rule facts --------------------------------------------------------------

    def _about_rules(self) -> DataFrame:
        """Names and texts of the rules, one row per rule: bounded by the rule list."""
        rows = []
        for index, rule in enumerate(self.rules):
            keys = list(rule.composite_columns or ())
            listed = [keys[i] if i < len(keys) else None for i in range(K.UNPACKED_KEYS)]
            rows.append(
                (
                    index, rule.rule_id, rule.dimension, rule.object, ",".join(rule.columns), rule.system,
                    rule.sub_system, rule.domain, rule.rule_type, rule.name, rule.description, rule.to_json(),
                    rule.category, rule.critical_attribute, rule.model_integrity,
                    K.key_names(rule.composite_columns), *listed,
                )
            )
        schema = (
            f"{RULE} int, rule_id string, dimension string, object string, attribute_name string, system string,"
            " sub_system string, domain string, rule_type string, applied_rule string, rule_description string,"
            " rule_json string, category string, critical_attribute string, model_integrity string,"
            " key_columns string, key1 string, key2 string, key3 string, key4 string"
        )
        return self.spark.createDataFrame(rows, schema)

    def _finished(self, shaped: DataFrame, columns: Sequence[str], layer: str | None) -> DataFrame:
        keyed = shaped.withColumn("unique_key", K.row_group_key())
        keyed = keyed.withColumn("rule_run_date", F.col("rule_run_date").cast("timestamp"))
        result = keyed.select(*columns)
        return result if layer is None else result.withColumn("lakehouse_layer", F.lit(layer))


def aggregates_text(names: Sequence[str]) -> Column:
    """Aggregates as the inside of a JSON object; NULL when there are none."""
    if not names:
        return F.lit(None).cast("string")
    whole = F.to_json(F.struct(*[named(n) for n in names]), {"ignoreNullFields": "false"})
    return F.regexp_replace(whole, r"^\{|\}$", "")


def zero_aggregates(rule: Rule) -> str | None:
    """Missing rows are outside every group; their image shows the aggregates of the condition as 0."""
    made = {c.alias for spec in rule.aggregations for c in spec.calculations}
    shown = dict.fromkeys(leaf.field for leaf in leaves(rule.having) if leaf.field in made)
    return ",".join(f'"{name}":0' for name in shown) or None


def reference_message(rule: Rule) -> str:
    return f"Consistency check failed for columns: {', '.join(rule.columns)}"
