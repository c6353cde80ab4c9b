"""UUIDs, transaction ids, checkpoints and segment names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values
GTID_END = 9223372036854775807
GTID_KINDS = {
    0: "AUTOMATIC",
    1: "ASSIGNED",
    2: "ANONYMOUS",
    3: "UNDEFINED",
    4: "NOT_YET_DETERMINED",
    5: "PRE_GENERATE_GTID",
}
SEGMENT_PREFIX = "ON"

_HEX = "[0-9a-fA-F]"
_DASHED = rf"{_HEX}{{8}}-{_HEX}{{4}}-{_HEX}{{4}}-{_HEX}{{4}}-{_HEX}{{12}}"


def normalize_uuid(text: Column) -> Column:
    """36-character, 32-character or braced UUID → lower case with dashes; NULL if invalid."""
    bare = F.lower(text)
    undashed = F.regexp_replace(bare, r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    return (
        F.when(text.rlike(f"^{_DASHED}$"), bare)
        .when(text.rlike(rf"^\{{{_DASHED}\}}$"), F.substring(bare, 2, 36))
        .when(text.rlike(rf"^{_HEX}{{32}}$"), undashed)
    )


def parse_gtid(text: Column) -> Column:
    """``uuid:n`` (blanks allowed around each part) → struct(sid, gno); NULL unless 0 < n < 2^63-1."""
    pattern = rf"^\s*({_DASHED})\s*:\s*(\d+)\s*$"
    sid = F.lower(F.regexp_extract(text, pattern, 1))
    gno = F.regexp_extract(text, pattern, 2).try_cast("long")
    valid = text.rlike(pattern) & (gno > 0) & (gno < GTID_END)
    return F.when(valid, F.struct(sid.alias("sid"), gno.alias("gno")))


def format_gtid(sid: Column, gno: Column) -> Column:
    return F.concat_ws(":", sid, gno.cast("string"))


def gtid_kind(code: Column, sid: Column | None = None, gno: Column | None = None) -> Column:
    """Text of a transaction id specification; assigned ids print as ``uuid:n``."""
    name = F.lit(None).cast("string")
    for value, text in GTID_KINDS.items():
        name = F.when(code == value, text).otherwise(name)
    if sid is None or gno is None:
        return name
    return F.when(code.isin(1, 3), format_gtid(sid, gno)).otherwise(name)


def parse_checkpoint(text: Column) -> Column:
    """``tx_seq-seq-scn`` → struct; NULL unless it has exactly three numeric parts (the last may be empty)."""
    parts = F.split(text, "-")
    tx_seq, seq = (F.try_element_at(parts, F.lit(i)).try_cast("decimal(20,0)") for i in (1, 2))
    last = F.try_element_at(parts, F.lit(3))
    scn = F.when(last == "", F.lit(0).cast("decimal(20,0)")).otherwise(last.try_cast("decimal(20,0)"))
    valid = (F.size(parts) == 3) & text.rlike(r"^\d+-\d+-\d*$") & tx_seq.isNotNull() & seq.isNotNull() & scn.isNotNull()
    return F.when(valid, F.struct(
        tx_seq.alias("tx_seq"),
        (seq % F.lit(1 << 32)).cast("long").alias("seq"),
        scn.alias("scn"),
    ))


def is_checkpoint(text: Column) -> Column:
    """Whether ``parse_checkpoint`` gives a result (false for NULL)."""
    return F.coalesce(parse_checkpoint(text).isNotNull(), F.lit(False))


def format_checkpoint(tx_seq: Column, seq: Column, scn: Column) -> Column:
    return F.concat_ws("-", tx_seq.cast("string"), seq.cast("string"), scn.cast("string"))


def segment_number(name: Column, prefix: str = SEGMENT_PREFIX) -> Column:
    """Number in a segment file name; NULL for other names."""
    return F.regexp_extract(name, rf"^{prefix}\.(\d+)", 1).try_cast("long")


def segment_name(number: Column, prefix: str = SEGMENT_PREFIX) -> Column:
    return F.format_string(f"{prefix}.%06d", number)
