"""Replaying a log onto tables: net changes, row history, conflicts, reconciliation.

Rules: an insert on a live key overwrites the row; an update or delete of a key that is not live changes nothing
and is a conflict; a column a record does not state keeps its value; an insert resets the columns it leaves out.

Because an insert or delete resets a key, a column of a row is the latest value stated *since the last reset*.
That is an aggregate (``net_changes``) that combines before the shuffle, so a key with any number of changes
arrives as one row per task; only per-change results (history, conflicts) carry state along the log.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.types import Field, typed_value
from tidemark.operators.images import stated, stated_value
from tidemark.operators.scans import HOT_ROWS, carry_forward
from tidemark.schema import ORDER, commit_key, commit_order, is_ddl

CHANGE_ORDER = (*ORDER, "sub")


def _order_columns() -> list[Column]:
    return [F.col(c) for c in CHANGE_ORDER]


def _place() -> Column:
    return F.struct(*CHANGE_ORDER)


def row_changes(log: DataFrame, fields: Sequence[Field], key: Sequence[str]) -> DataFrame:
    """Row changes of one table: key columns, ``op``, commit order, and per other column a struct of its value
    (NULL when the record does not state it).

    An update that moves the key and states the whole row becomes a delete and an insert. One that moves the key
    without the whole row is left to ``partial_moves``.
    """
    found = _stated_sides(log, fields, key)
    split = (F.col("op_type") == "U") & _moved(fields, key)
    whole = reduce(lambda a, b: a & b, [F.col(f"_a_{f.name}").isNotNull() for f in fields])
    # what a record becomes: nothing if it cannot be replayed, two changes if it moves its row, else one
    step = [F.struct(F.lit(sub).alias("sub"), F.lit(both).alias("split")) for sub, both in ((0, False), (0, True), (1, True))]
    none = F.array().cast("array<struct<sub:int,split:boolean>>")
    steps = (F.when(_keyless(key), none).when(~F.coalesce(split, F.lit(False)), F.array(step[0]))
             .when(whole, F.array(step[1], step[2])).otherwise(none))
    rows = found.select("*", F.explode(steps).alias("_x")).select("*", F.col("_x.sub").alias("sub"))
    leaves = F.col("_x.split") & (F.col("sub") == 0)  # the row under its old key
    op = F.when(F.col("_x.split"), F.when(F.col("sub") == 0, "D").otherwise("I")).otherwise(F.col("op_type"))
    from_after = (F.col("op_type") == "I") | (F.col("sub") == 1)

    def key_value(f: Field) -> Column:
        return typed_value(F.when(from_after, F.col(f"_a_{f.name}")).otherwise(F.col(f"_b_{f.name}")), f).alias(f.name)

    of = {f.name: f for f in fields}
    return rows.select(
        *[key_value(of[k]) for k in key], op.alias("op"), *CHANGE_ORDER,
        *[F.when(~leaves, stated_value(F.col(f"_a_{f.name}"), f)).alias(f.name) for f in fields if f.name not in key])


def _stated_sides(log: DataFrame, fields: Sequence[Field], key: Sequence[str]) -> DataFrame:
    """Key columns before (``_b_``) and all columns after (``_a_``) a row change, as stated.

    They come out of an array of one, which the optimizer leaves alone: written into every place that names them, the
    code of the larger tables outgrows what the JVM compiles.
    """
    order = [*commit_order()[:4], commit_order()[4].alias("dn")]
    sides = {**{f"_b_{f.name}": stated(F.col("keys"), f.name) for f in fields if f.name in key},
             **{f"_a_{f.name}": stated(F.col("new_data"), f.name) for f in fields}}
    packed = log.filter(F.col("op_type").isin("I", "U", "D")).select(
        *order, "op_type", F.explode(F.array(F.struct(*[c.alias(n) for n, c in sides.items()]))).alias("_s"))
    return packed.select(*ORDER, "op_type", *[F.col("_s")[n].alias(n) for n in sides])


def _keyless(key: Sequence[str]) -> Column:
    """Whether a row change leaves out part of the key of its row, or states it as NULL."""
    sides = [F.when(F.col("op_type") == "I", F.col(f"_a_{k}")).otherwise(F.col(f"_b_{k}")) for k in key]
    return reduce(lambda a, b: a | b, [s.isNull() | (s["tag"] == "NONE") for s in sides])


def keyless_changes(log: DataFrame, fields: Sequence[Field], key: Sequence[str]) -> DataFrame:
    """Row changes that do not state their key and therefore cannot be replayed; ``row_changes`` leaves them out."""
    return _stated_sides(log, fields, key).filter(_keyless(key)).select(*ORDER, "op_type")


def _moved(fields: Sequence[Field], key: Sequence[str]) -> Column:
    """Whether an update states a key other than the one it finds its row by."""
    return reduce(lambda a, b: a | b, [
        F.col(f"_a_{f.name}").isNotNull() & ~typed_value(F.col(f"_a_{f.name}"), f).eqNullSafe(
            typed_value(F.col(f"_b_{f.name}"), f)) for f in fields if f.name in key])


def _partial_move(fields: Sequence[Field], key: Sequence[str]) -> Column:
    whole = reduce(lambda a, b: a & b, [F.col(f"_a_{f.name}").isNotNull() for f in fields])
    return (F.col("op_type") == "U") & _moved(fields, key) & ~whole


def partial_moves(log: DataFrame, fields: Sequence[Field], key: Sequence[str]) -> DataFrame:
    """Updates that change the key without stating the whole row; they cannot be applied."""
    return _stated_sides(log, fields, key).filter(_partial_move(fields, key)).select(*ORDER)


def value_columns(changes: DataFrame, key: Sequence[str]) -> list[str]:
    return [c for c in changes.columns if c not in key and c not in CHANGE_ORDER and c != "op"]


def key_states(changes: DataFrame, key: Sequence[str]) -> DataFrame:
    """What is known of each key: its last reset (insert or delete) and, per column, the last value stated and where.

    States of disjoint or overlapping parts of a log can be put together with ``merge_states`` in any order.
    """
    place = F.struct(*CHANGE_ORDER)
    return changes.groupBy(*key).agg(
        F.max(F.when(F.col("op").isin("I", "D"), F.struct(place.alias("at"), "op"))).alias("reset"),
        F.max(place).alias("last"),
        F.count(F.lit(1)).alias("n_changes"),
        *[F.max(F.when(F.col(c).isNotNull(), F.struct(place.alias("at"), F.col(c).alias("s")))).alias(c)
          for c in value_columns(changes, key)],
    )


def _state_columns(states: DataFrame, key: Sequence[str]) -> list[str]:
    return [c for c in states.columns if c not in key and c not in ("reset", "last", "n_changes")]


def merge_states(states: DataFrame, key: Sequence[str]) -> DataFrame:
    """One state per key out of several: the latest of each part wins."""
    return states.groupBy(*key).agg(
        F.max("reset").alias("reset"), F.max("last").alias("last"), F.sum("n_changes").alias("n_changes"),
        *[F.max(c).alias(c) for c in _state_columns(states, key)])


def settle(states: DataFrame, key: Sequence[str], ended: DataFrame | None = None) -> DataFrame:
    """States to net changes: values stated before the last reset no longer count.

    ``ended`` has one row, ``at``: the commit key of the last definition that left the table empty, or NULL. It resets
    every key like a delete; keys without a change since then are gone.
    """
    if ended is not None:
        at = ended.select(F.when(F.col("at").isNotNull(), F.struct("at.*", F.lit(-1).alias("sub"))).alias("_ended"))
        emptied = F.struct(F.col("_ended").alias("at"), F.lit("D").alias("op"))
        states = states.join(F.broadcast(at)).withColumn("reset", F.when(  # one row
            F.col("_ended").isNull() | (F.col("reset.at") > F.col("_ended")), F.col("reset")).otherwise(emptied)).drop("_ended")
    op = F.coalesce(F.col("reset.op"), F.lit("U"))
    fresh = {c: F.when(F.col("reset").isNull() | (F.col(f"{c}.at") >= F.col("reset.at")), F.col(f"{c}.s"))
             for c in _state_columns(states, key)}
    return states.select(*key, op.alias("op"), "n_changes", F.col("last.tx_seq").alias("last_tx"),
                         *[F.when(op != "D", value).alias(c) for c, value in fresh.items()])


def net_changes(changes: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row per key: net ``op`` (I, U or D), number of changes, and per column the struct of its last value
    (NULL when the net change does not touch it)."""
    return settle(key_states(changes, key), key)


def apply_net(base: DataFrame, net: DataFrame, key: Sequence[str]) -> DataFrame:
    """The table after the net changes. Both sides have one row per key."""
    columns = [c for c in base.columns if c not in key]
    old = base.withColumn("_known", F.lit(True)).select(*key, "_known", *[F.col(c).alias(f"_o_{c}") for c in columns])
    new = net.select(*key, "op", *[F.col(c).alias(f"_n_{c}") for c in columns])
    joined = old.join(new, list(key), "full_outer")
    live = F.col("op").isNull() | (F.col("op") == "I") | ((F.col("op") == "U") & F.col("_known"))

    def value(c: str) -> Column:
        stated = F.col(f"_n_{c}")
        kept = F.when(F.col("op") == "I", F.lit(None)).otherwise(F.col(f"_o_{c}"))
        return F.when(stated.isNotNull(), F.col(f"_n_{c}.v")).otherwise(kept).alias(c)

    return joined.filter(live).select(*key, *[value(c) for c in columns])


def replay(base: DataFrame, log: DataFrame, fields: Sequence[Field], key: Sequence[str]) -> DataFrame:
    """The table ``base`` after the records of ``log``."""
    return apply_net(base, net_changes(row_changes(log, fields, key), key), key)


def table_resets(log: DataFrame, db: str, table: str) -> DataFrame:
    """One row: ``at``, the commit key of the last definition that leaves a table empty (NULL if there is none).

    These are its ``CREATE TABLE``, ``DROP TABLE`` and ``TRUNCATE``, and a ``DROP DATABASE`` (whose record names neither).
    """
    own = (F.col("db_name") == db) & (F.col("table_") == table)
    sql = F.lower(F.trim(F.coalesce("ddl_sql", F.lit(""))))
    emptied = own & (F.col("ddl_type").isin("CREATE TABLE", "DROP TABLE") | sql.rlike("^truncate\\b"))
    dropped = sql.rlike("^drop\\s+(database|schema)\\b") & (
        F.regexp_extract(sql, "^drop\\s+(?:database|schema)\\s+(?:if\\s+exists\\s+)?[`\"]?([^`\"\\s;]+)", 1) == db.lower())
    empties = F.coalesce(emptied, F.lit(False)) | dropped
    return log.filter(is_ddl() & empties).agg(F.max(commit_key()).alias("at"))


def since_last_drop(log: DataFrame, db: str, table: str) -> DataFrame:
    """Row changes of a table after the last definition that left it empty."""
    rows = log.filter((F.col("db_name") == db) & (F.col("table_") == table) & ~is_ddl())
    reset = F.broadcast(table_resets(log, db, table))  # one row
    return rows.join(reset, F.col("at").isNull() | (commit_key() > F.col("at"))).drop("at")


def replay_table(base: DataFrame, log: DataFrame, db: str, table: str, fields: Sequence[Field],
                 key: Sequence[str]) -> DataFrame:
    """``replay`` of one table out of a log with definitions: what a drop, truncation or creation ends does not count."""
    still = base.join(F.broadcast(table_resets(log, db, table)), F.col("at").isNull()).drop("at")
    return replay(still, since_last_drop(log, db, table), fields, key)



def _changed_keys(changes: DataFrame, key: Sequence[str]) -> DataFrame:
    return changes.select(*key).distinct()


def rows_touched(base: DataFrame, changes: DataFrame, key: Sequence[str]) -> DataFrame:
    return base.join(_changed_keys(changes, key), list(key), "left_semi")


def rows_untouched(base: DataFrame, changes: DataFrame, key: Sequence[str]) -> DataFrame:
    return base.join(_changed_keys(changes, key), list(key), "left_anti")


def _with_base(changes: DataFrame, base: DataFrame | None, key: Sequence[str]) -> DataFrame:
    """Put the rows of a base table before the log, as inserts that are not part of the result."""
    columns = value_columns(changes, key)
    marked = changes.withColumn("_base", F.lit(False))
    if base is None:
        return marked
    first = base.select(
        *key, F.lit("I").alias("op"),
        *[F.lit(-1).cast(changes.schema[c].dataType).alias(c) for c in CHANGE_ORDER],
        *[(F.struct(F.col(c).cast(changes.schema[c].dataType["v"].dataType).alias("v")) if c in base.columns
           else F.lit(None).cast(changes.schema[c].dataType)).alias(c) for c in columns],
        F.lit(True).alias("_base"),
    )
    return first.unionByName(marked)


def _reset() -> Column:
    return F.when(F.col("op").isin("I", "D"), F.struct(_place().alias("at"), F.col("op").alias("op")))


def replay_conflicts(changes: DataFrame, key: Sequence[str], base: DataFrame | None = None,
                     hot_rows: int = HOT_ROWS) -> DataFrame:
    """Changes that find their key in the wrong state, with a ``reason``."""
    narrow = changes.select(*key, "op", *CHANGE_ORDER)
    staged = _with_base(narrow, base.select(*key) if base is not None else None, key)
    known = carry_forward(staged, key, _order_columns(), {"_live": F.when(F.col("op").isin("I", "D"), F.col("op") == "I")},
                          strict=True, hot_rows=hot_rows).filter(~F.col("_base"))
    live = F.coalesce("_live", F.lit(False))
    reason = (F.when((F.col("op") == "I") & live, "insert_exists").when((F.col("op") == "U") & ~live, "update_missing")
              .when((F.col("op") == "D") & ~live, "delete_missing"))
    return known.withColumn("reason", reason).filter(F.col("reason").isNotNull()).drop("_live", "_base")


def _carried(changes: DataFrame, key: Sequence[str], base: DataFrame | None, strict: bool, hot_rows: int) -> DataFrame:
    columns = value_columns(changes, key)
    values = {"_r": _reset()}
    values |= {f"_c_{c}": F.when(F.col(c).isNotNull(), F.struct(_place().alias("at"), F.col(c).alias("s"))) for c in columns}
    staged = _with_base(changes, base, key)
    return carry_forward(staged, key, _order_columns(), values, strict, hot_rows).filter(~F.col("_base"))


def _since_reset(c: str) -> Column:
    return F.when(F.col(f"_c_{c}.at") >= F.col("_r.at"), F.col(f"_c_{c}.s.v"))


def row_history(changes: DataFrame, key: Sequence[str], base: DataFrame | None = None,
                hot_rows: int = HOT_ROWS) -> DataFrame:
    """The row after each insert and each update of a live key."""
    columns = value_columns(changes, key)
    carried = _carried(changes, key, base, False, hot_rows)
    return carried.filter((F.col("op") != "D") & (F.col("_r.op") == "I")).select(
        *key, "op", *CHANGE_ORDER, *[_since_reset(c).alias(c) for c in columns])


def before_images(changes: DataFrame, key: Sequence[str], base: DataFrame | None = None,
                  hot_rows: int = HOT_ROWS) -> DataFrame:
    """The row before each update or delete of a live key."""
    columns = value_columns(changes, key)
    carried = _carried(changes, key, base, True, hot_rows)
    return carried.filter((F.col("op") != "I") & (F.col("_r.op") == "I")).select(
        *key, "op", *CHANGE_ORDER, *[_since_reset(c).alias(c) for c in columns])


def reconcile(actual: DataFrame, expected: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys on which two tables differ: ``missing``, ``extra`` or ``different``. Empty when they agree."""
    columns = [c for c in expected.columns if c not in key]
    left = actual.select(*key, F.struct(*columns).alias("_l")) if columns else actual.select(*key, F.lit(True).alias("_l"))
    right = expected.select(*key, F.struct(*columns).alias("_r")) if columns else expected.select(*key, F.lit(True).alias("_r"))
    side = (F.when(F.col("_l").isNull(), "missing").when(F.col("_r").isNull(), "extra")
            .when(~F.col("_l").eqNullSafe(F.col("_r")), "different"))
    return left.join(right, list(key), "full_outer").select(*key, side.alias("side")).filter(F.col("side").isNotNull())
