"""Generations of a table: what its rows mean across drops, truncations, creations, renames and drops of its database.

A definition that leaves a table empty ends a generation. Keys of one generation know nothing of another, so the
generation is part of the key wherever state is carried along a log. A rename hands the current generation of one name
to another: its earlier records, told under the old name, belong to the generation the new name begins with.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.types import Field
from tidemark.operators import replay
from tidemark.operators.replay import CHANGE_ORDER
from tidemark.operators.scans import HOT_ROWS, add_places, running_total
from tidemark.schema import commit_key, is_ddl
from tidemark.session import durable

GENERATION = "generation"
SENT_RESETS = 1_000
"""Resets of a table up to which each change finds its place among them; more are counted by a running total."""
_NAME = r"""(?:`[^`]+`|"[^"]+"|[^\s,;.`"()]+)"""
_TABLE = rf"{_NAME}(?:\s*\.\s*{_NAME})?"
_DROP = r"(?i)^drop\s+(?:temporary\s+)?tables?\s+(?:if\s+exists\s+)?"
_DROP_DB = r"(?i)^drop\s+(?:database|schema)\s+(?:if\s+exists\s+)?"
_TRUNCATE = r"(?i)^truncate\s+(?:table\s+)?"
_CREATE = r"(?i)^create\s+(?:temporary\s+)?table\s+(?:if\s+not\s+exists\s+)?"
_RENAME = r"(?i)^rename\s+tables?\s+"
_ALTER_RENAME = rf"(?i)^alter\s+table\s+({_TABLE})\s+(?:.*,\s*)?rename\s+(?:to\s+|as\s+|=\s*)?(?!column\b|index\b|key\b)({_TABLE})"


def _unquoted(name: Column) -> Column:
    return F.translate(name, '`"', "")


def _part(name: Column, group: int) -> Column:
    return F.nullif(_unquoted(F.regexp_extract(name, rf"^\s*(?:({_NAME})\s*\.\s*)?({_NAME})", group)), F.lit(""))


def definitions(log: DataFrame) -> DataFrame:
    """One row for each table that a definition creates, drops, truncates or renames, or for each database it drops:
    the commit order, ``kind``, ``db``, ``name``, and for renames ``to_db`` and ``to_name``."""
    sql = F.trim(F.coalesce("ddl_sql", F.lit("")))
    pair = "array<struct<old:string,new:string>>"

    def names(listed: Column) -> Column:
        return F.transform(listed, lambda n: F.struct(n.alias("old"), F.lit(None).cast("string").alias("new"))).cast(pair)

    def after(prefix: str, many: bool = False) -> Column:
        rest = F.regexp_replace(sql, prefix, "")
        found = F.regexp_extract_all(rest, F.lit(rf"(?:^|,)\s*({_TABLE})"), F.lit(1))
        return names(found if many else F.slice(found, 1, 1))

    renamed = F.regexp_extract_all(F.regexp_replace(sql, _RENAME, ""), F.lit(rf"(?i)({_TABLE})\s+to\s+({_TABLE})"), F.lit(1))
    to = F.regexp_extract_all(F.regexp_replace(sql, _RENAME, ""), F.lit(rf"(?i)({_TABLE})\s+to\s+({_TABLE})"), F.lit(2))
    own = F.array(F.struct(F.concat(F.lit("`"), F.col("table_"), F.lit("`")).alias("old"), F.lit(None).cast("string").alias("new"))).cast(pair)
    none = F.array().cast(pair)
    moved = F.array(F.struct(F.regexp_extract(sql, _ALTER_RENAME, 1).alias("old"), F.regexp_extract(sql, _ALTER_RENAME, 2).alias("new"))).cast(pair)
    kind = (F.when(sql.rlike(_DROP_DB), "drop database").when(sql.rlike(_DROP), "drop").when(sql.rlike(_TRUNCATE), "truncate")
            .when(sql.rlike(_RENAME) | sql.rlike(_ALTER_RENAME), "rename").when(sql.rlike(_CREATE), "create")
            .when((F.col("ddl_type") == "CREATE TABLE") & F.col("table_").isNotNull(), "create")
            .when((F.col("ddl_type") == "DROP TABLE") & F.col("table_").isNotNull(), "drop"))
    told = F.col("table_").isNotNull()
    tables = (F.when(sql.rlike(_DROP_DB), after(_DROP_DB)).when(sql.rlike(_DROP), F.array_distinct(
        F.concat(after(_DROP, many=True), F.when(told, own).otherwise(none))))
              .when(sql.rlike(_RENAME), F.arrays_zip(renamed.alias("old"), to.alias("new")).cast(pair)).when(sql.rlike(_ALTER_RENAME), moved)
              .when(told, own).when(sql.rlike(_TRUNCATE), after(_TRUNCATE)).when(sql.rlike(_CREATE), after(_CREATE)).otherwise(none))
    ddl = log.filter(is_ddl()).select(*[c for c in CHANGE_ORDER if c != "sub"], commit_key().alias("at"), "db_name", kind.alias("kind"),
                                      F.explode(tables).alias("t")).filter(F.col("kind").isNotNull())
    whole = F.col("kind") == "drop database"
    return ddl.select(
        "at", "kind",
        F.when(whole, _part(F.col("t.old"), 2)).otherwise(F.coalesce(_part(F.col("t.old"), 1), "db_name")).alias("db"),
        F.when(~whole, _part(F.col("t.old"), 2)).alias("name"),
        F.when(F.col("t.new").isNotNull(), F.coalesce(_part(F.col("t.new"), 1), "db_name")).alias("to_db"),
        _part(F.col("t.new"), 2).alias("to_name")).distinct()  # the record's own table is often named in the statement as well


def _is(db: str, table: str, prefix: str = "") -> Column:
    return (F.col(f"{prefix}db") == db) & (F.col(f"{prefix}name") == table)


def resets(log: DataFrame, db: str, table: str) -> DataFrame:
    """``at``: the commit keys at which a generation of the table ends; a rename to its name begins one as well."""
    return _resets(definitions(log), db, table)


def _resets(defined: DataFrame, db: str, table: str) -> DataFrame:
    own = _is(db, table) | ((F.col("kind") == "drop database") & (F.lower("db") == db.lower())) | _is(db, table, "to_")
    return defined.filter(F.coalesce(own, F.lit(False))).select("at").distinct()


@dataclass(frozen=True)
class Span:
    """Records of a name after one commit key and before another (None: from the start, to the end); ``generation`` of
    the table they belong to, None where it follows from the table's own resets."""

    db: str
    table: str
    after: tuple | None = None
    until: tuple | None = None
    generation: int | None = None


def _key(place: Sequence) -> Column:
    return F.struct(*[F.lit(v).cast("short" if c == "dn" else "long").alias(c) for c, v in zip(CHANGE_ORDER, place)])


def spans(log: DataFrame, db: str, table: str) -> list[Span]:
    """Where the records of a table are told: under its name, and under the names its generations had before renames.

    A few small aggregates over the definitions for each rename that led to the name.
    """
    return _spans(durable(definitions(log)), db, table)


def _spans(defined: DataFrame, db: str, table: str) -> list[Span]:
    found = [Span(db, table)]
    asked = [(db, table, None, None)]
    while asked:
        own_db, own_table, until, generation = asked.pop()
        into = defined.filter((F.col("kind") == "rename") & _is(own_db, own_table, "to_"))
        if until is not None:  # of the renames before it only the last one led on
            into = into.filter(F.col("at") < _key(until)).orderBy(F.desc("at")).limit(1)
        for row in into.collect():
            at = tuple(row["at"])
            earlier = _resets(defined, row["db"], row["name"]).filter(F.col("at") < _key(at)).agg(F.max("at")).first()[0]
            if until is not None and (later := _resets(defined, own_db, own_table).filter((F.col("at") > _key(at)) & (F.col("at") < _key(until)))).first():
                continue  # what that rename brought was dropped before this one
            number = generation if generation is not None else _resets(defined, db, table).filter(F.col("at") <= _key(at)).count()
            found.append(Span(row["db"], row["name"], tuple(earlier) if earlier else None, at, number))
            asked.append((row["db"], row["name"], at, number))
    return found


def table_changes(log: DataFrame, db: str, table: str, fields: Sequence[Field], key: Sequence[str]) -> DataFrame:
    """``replay.row_changes`` of a table with its ``generation`` (0 before the first reset)."""
    def own(span: Span) -> DataFrame:
        rows = log.filter((F.col("db_name") == span.db) & (F.col("table_") == span.table) & ~is_ddl())
        if span.after is not None:
            rows = rows.filter(commit_key() > _key(span.after))
        if span.until is not None:
            rows = rows.filter(commit_key() < _key(span.until))
        return replay.row_changes(rows, fields, key)

    defined = durable(definitions(log))  # asked several times, and the log is read for it once
    first, *before = _spans(defined, db, table)
    # a generation that was renamed away and back again is told once, as part of the one that came back
    back = [s for s in before if (s.db, s.table) == (db, table)]
    once = log
    for s in back:
        inside = (commit_key() < _key(s.until)) & (F.lit(True) if s.after is None else commit_key() > _key(s.after))
        once = once.filter(is_ddl() | ~inside | ~((F.col("db_name") == db) & (F.col("table_") == table)))
    changes = replay.row_changes(once.filter((F.col("db_name") == db) & (F.col("table_") == table) & ~is_ddl()), fields, key)
    out = _numbered_generations(changes, _resets(defined, db, table))
    for span in before:
        out = out.unionByName(own(span).withColumn(GENERATION, F.lit(span.generation).cast("long")))
    return out


def _numbered_generations(changes: DataFrame, ends: DataFrame) -> DataFrame:
    """Add ``generation``: how many of the resets ``ends`` are before each change."""
    order = [F.col(c) for c in CHANGE_ORDER]
    marks = ends.select("at.*", F.lit(-1).alias("sub"))
    if len(marks.take(SENT_RESETS + 1)) <= SENT_RESETS:
        places = marks.agg(F.sort_array(F.collect_list(F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)]))).alias("bounds"))
        return add_places(changes, order, places, GENERATION).withColumn(GENERATION, F.col(GENERATION).cast("long"))
    told = changes.withColumn("_mark", F.lit(False)).unionByName(marks.withColumn("_mark", F.lit(True)), allowMissingColumns=True)
    return running_total(told, order, {GENERATION: F.col("_mark").cast("long")}).filter(~F.col("_mark")).drop("_mark")


def _with_generation(base: DataFrame | None) -> DataFrame | None:
    return base.withColumn(GENERATION, F.lit(0).cast("long")) if base is not None else None


def current(changes: DataFrame, log: DataFrame, db: str, table: str) -> DataFrame:
    """Changes of the generation the table has at the end of the log."""
    last = resets(log, db, table).agg(F.count(F.lit(1)).alias("_last"))
    return changes.join(F.broadcast(last), F.col(GENERATION) == F.col("_last")).drop("_last", GENERATION)  # one row


def replay_table(base: DataFrame, log: DataFrame, db: str, table: str, fields: Sequence[Field], key: Sequence[str]) -> DataFrame:
    """The table ``base`` after the records of ``log``, definitions and renames included."""
    changes = current(table_changes(log, db, table, fields, key), log, db, table)
    still = base.join(F.broadcast(resets(log, db, table).agg(F.max("at").alias("_at"))), F.col("_at").isNull()).drop("_at")  # one row
    return replay.apply_net(still, replay.net_changes(changes, key), key)


def row_history(log: DataFrame, db: str, table: str, fields: Sequence[Field], key: Sequence[str],
                base: DataFrame | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``replay.row_history`` with the generation of each row."""
    return replay.row_history(table_changes(log, db, table, fields, key), [*key, GENERATION], _with_generation(base), hot_rows)


def before_images(log: DataFrame, db: str, table: str, fields: Sequence[Field], key: Sequence[str],
                  base: DataFrame | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``replay.before_images`` with the generation of each row."""
    return replay.before_images(table_changes(log, db, table, fields, key), [*key, GENERATION], _with_generation(base), hot_rows)


def replay_conflicts(log: DataFrame, db: str, table: str, fields: Sequence[Field], key: Sequence[str],
                     base: DataFrame | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``replay.replay_conflicts`` within each generation."""
    return replay.replay_conflicts(table_changes(log, db, table, fields, key), [*key, GENERATION], _with_generation(base), hot_rows)
