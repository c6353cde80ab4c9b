"""Records as transactions of typed events, with their sizes and positions in the log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numeric import whole_div
from tidemark.functions import size, types
from tidemark.operators.normalize import commit_times, row_event_code
from tidemark.operators.scans import running_total
from tidemark.schema import ORDER, commit_order, is_ddl

# Fixed values
EVENT_CODES = {"GTID": 33, "QUERY": 2, "TABLE_MAP": 19, "WRITE_ROWS": 30, "UPDATE_ROWS": 31, "DELETE_ROWS": 32,
               "XID": 16, "ROTATE": 4}
BEGIN = "BEGIN"
THREAD_ID = 10000
ERROR_CODE = 0
TIME_ZONE = "SYSTEM"
SERVER_VERSION = 80032
ANONYMOUS = "ANONYMOUS"


def _kind(ordinal: Column) -> Column:
    rows = (F.when(F.col("op_type") == "I", "WRITE_ROWS").when(F.col("op_type") == "U", "UPDATE_ROWS")
            .when(F.col("op_type") == "D", "DELETE_ROWS").otherwise("UNKNOWN"))
    return (F.when(ordinal == 1, "GTID").when(ordinal == 2, "QUERY").when(ordinal == 3, "TABLE_MAP")
            .when(ordinal == 4, rows).otherwise("XID"))


def _code(kind: Column) -> Column:
    code = F.lit(0)
    for name, value in EVENT_CODES.items():
        code = F.when(kind == name, value).otherwise(code)
    return code


def explode_events(log: DataFrame) -> DataFrame:
    """Two events per definition (GTID, QUERY), five per row change (GTID, QUERY, TABLE_MAP, rows, XID).

    Only the event ordinal is exploded; what an event holds is a projection of its record, so columns that are
    not read are not built.
    """
    exploded = log.select("*", F.explode(event_ordinals()).alias("event_ord"))
    return exploded.withColumn("event_type", _kind(F.col("event_ord"))).withColumn("event_code", _code(F.col("event_type")))


def ddl_events(log: DataFrame) -> DataFrame:
    return explode_events(log.filter(is_ddl()))


def dml_events(log: DataFrame) -> DataFrame:
    return explode_events(log.filter(~is_ddl()))


def own_parts(events: DataFrame) -> DataFrame:
    """Exploded events of which each holds its own part of the record: the field list goes with the table map, the images
    with the rows. Written out, a record takes its own size and not that of its events times as much."""
    ordinal = F.col("event_ord")
    return events.withColumns({
        "fields": F.when(ordinal == 3, F.col("fields")),
        **{image: F.when(ordinal == 4, F.col(image)) for image in ("keys", "new_data")}})


def gtid_payload() -> Column:
    """Commit order and times; the original time only where it differs."""
    return F.struct(
        F.lit(ANONYMOUS).alias("kind"),
        F.col("last_commit").alias("last_committed"),
        F.col("tx_seq").alias("sequence_number"),
        F.col("immediate_us"),
        F.when(F.col("original_us") != F.col("immediate_us"), F.col("original_us")).alias("original_us"),
        F.lit(SERVER_VERSION).alias("server_version"),
    )


def query_payload() -> Column:
    """Statement text; definitions carry their transaction number and session variables."""
    return F.struct(
        F.col("db_name"),
        F.when(is_ddl(), F.col("ddl_sql")).otherwise(BEGIN).alias("sql"),
        F.when(is_ddl(), F.col("tx_seq")).alias("xid"),
        F.lit(THREAD_ID).alias("thread_id"),
        F.lit(ERROR_CODE).alias("error_code"),
        F.when(is_ddl(), TIME_ZONE).alias("time_zone"),
    )


def table_map_payload() -> Column:
    """Column count, type codes, metadata and nullability of a row change's table."""
    def metadata(f: Column) -> Column:
        first, second = types.metadata_bytes(f["meta"]["data_type"], f["meta"]["length"], f["meta"]["precision"])
        return F.array_compact(F.array(first, second))

    return F.struct(
        F.col("db_name"),
        F.col("table_"),
        F.size("fields").alias("n_columns"),
        F.transform("fields", lambda f: types.logged_type_code(f["meta"]["data_type"])).alias("type_codes"),
        F.flatten(F.transform("fields", metadata)).alias("metadata"),
        F.transform("fields", lambda f: f["meta"]["nullable"]).alias("nullable"),
    )


def change_events(log: DataFrame) -> DataFrame:
    """All events of a log with their header and per-type payload (NULL for other types)."""
    ordinal = F.col("event_ord")
    events = explode_events(commit_times(log))
    return events.select(
        *ORDER, "check_point", "op_type", "event_ord", "event_type", "event_code",
        whole_div(F.col("immediate_us"), 1_000_000).alias("commit_second"),
        F.lit(size.SERVER_ID).alias("server_id"),
        F.when(ordinal == 1, gtid_payload()).alias("gtid"),
        F.when(ordinal == 2, query_payload()).alias("query"),
        F.when(ordinal == 3, table_map_payload()).alias("table_map"),
        F.when(ordinal == 4, F.struct("keys", "new_data")).alias("rows"),
        F.when(ordinal == 5, F.col("tx_seq")).alias("xid"),
    )


def event_sizes(log: DataFrame) -> DataFrame:
    """Add ``ends``: the end of each event of a record, in bytes from the start of the record."""
    ddl = is_ddl()
    # what is read for each value is put into columns of its own, or it would be worked out again for every value
    parted = {f"_{image}_{part}": F.col(image)[part] for image in ("keys", "new_data") for part in size.IMAGE_PARTS}
    described = commit_times(log).withColumns({"_traits": size.field_traits(F.col("fields")), **parted}).withColumns({
        "_names": F.col("fields")["name"],
        "_widths": size.field_widths(F.col("fields"), F.col("_traits")),
        "_prefixed": F.col("_traits")["prefixed"],
    })
    images = [[F.col(f"_{image}_{part}") for part in size.IMAGE_PARTS] for image in ("keys", "new_data")]
    parts = described.withColumns({
        "_gtid": size.gtid_bytes(F.col("immediate_us"), F.col("original_us")),
        "_query": F.when(ddl, size.ddl_query_bytes(F.col("db_name"), F.col("ddl_sql"))).otherwise(
            size.begin_bytes(F.col("db_name"))),
        "_map": F.when(~ddl, size.table_map_bytes(F.col("db_name"), F.col("table_"), F.col("_traits"))),
        "_rows": F.when(~ddl, size.rows_bytes(*images, F.col("_names"), F.col("_widths"), F.col("_prefixed"))),
    }).drop("_traits", "_names", "_widths", "_prefixed", *parted)
    e1 = F.col("_gtid").cast("long")
    e2 = e1 + F.col("_query")
    e3 = e2 + F.col("_map")
    e4 = e3 + F.col("_rows")
    ends = F.when(ddl, F.array(e1, e2)).otherwise(F.array(e1, e2, e3, e4, e4 + F.lit(size.XID_BYTES)))
    # A lambda, so that sizes are not compiled into one method with what follows: the JVM leaves methods beyond 8,000 bytes
    # interpreted
    return parts.withColumn("ends", F.transform(ends, lambda e: e)).drop("_gtid", "_query", "_map", "_rows")


def event_ordinals() -> Column:
    """The ordinals of a record's events, as an array to explode."""
    return F.when(is_ddl(), F.array(F.lit(1), F.lit(2))).otherwise(F.array(*[F.lit(i) for i in range(1, 6)]))


def _event_columns(base: Column | None = None) -> list[Column]:
    """Length (and end, counted from ``base``) of event ``event_ord`` of a record with the event ends ``ends``."""
    at = F.col("event_ord")
    end = F.element_at("ends", at)
    start = F.when(at == 1, F.lit(0).cast("long")).otherwise(F.try_element_at("ends", at - 1))
    columns = [at, (end - start).alias("event_len")]
    if base is not None:
        columns.append((base + end).alias("end_pos"))
    return columns


def explode_ends() -> Column:
    """``event_ord`` for each entry of ``ends``.

    Exploding the column itself would make the optimizer filter on its size, that is, compute it twice.
    """
    return F.explode(F.sequence(F.lit(1), F.size("ends"))).alias("event_ord")


def sized_events(log: DataFrame, keep: Sequence[str] = ORDER) -> DataFrame:
    """One row per event with its length."""
    exploded = event_sizes(log).select(*keep, "ends", explode_ends())
    return exploded.select(*keep, *_event_columns())


def transaction_bytes(log: DataFrame) -> DataFrame:
    """Bytes and records of each transaction."""
    return event_sizes(log).groupBy("tx_seq").agg(
        F.sum(F.element_at("ends", -1)).alias("bytes"), F.count(F.lit(1)).alias("n_records"))


def record_positions(log: DataFrame, keep: Sequence[str] = (), buckets: int | None = None) -> DataFrame:
    """``start_pos`` of each record in the whole log and the ``ends`` of its events."""
    columns = list(dict.fromkeys([*ORDER, *keep]))
    sized = event_sizes(log).select(*columns, "ends")
    placed = running_total(sized, commit_order(), {"_through": F.element_at("ends", -1)}, buckets)
    return placed.select(*columns, "ends", (F.col("_through") - F.element_at("ends", -1)).alias("start_pos"))


def log_positions(log: DataFrame, keep: Sequence[str] = (), buckets: int | None = None) -> DataFrame:
    """One row per event with its length and its end position in the whole log.

    Positions are accumulated per record and only then spread over the record's events.
    """
    columns = list(dict.fromkeys([*ORDER, *keep]))
    placed = record_positions(log, keep, buckets)
    return placed.select(*columns, "ends", "start_pos", explode_ends()).select(*columns, *_event_columns(F.col("start_pos")))


def event_headers(log: DataFrame, buckets: int | None = None) -> DataFrame:
    """The common header of each event: commit second, type, server, length, end position, flags."""
    staged = commit_times(log).withColumn("commit_second", whole_div(F.col("immediate_us"), 1_000_000))
    placed = log_positions(staged, ("op_type", "commit_second"), buckets)
    kind = _kind(F.col("event_ord"))
    return placed.select(
        *ORDER, "event_ord", "commit_second", _code(kind).alias("event_code"),
        F.lit(size.SERVER_ID).alias("server_id"), "event_len", "end_pos", F.lit(0).alias("flags"))


def decode_ops(log: DataFrame) -> DataFrame:
    return log.withColumn("event_code", row_event_code(F.col("op_type")))
