"""Every copy of a repeated key on a stream, the first one included, as the batch duplicate rule flags them."""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.text import named
from .checks import watched

# times to the microsecond survive the way through a record
JSON = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
OUT = "record string"
STATE = "kept binary"
#: Parts of the keys; a checkpoint is bound to the number it was made with.
BUCKETS = 1024


def _milliseconds(delay: str) -> int:
    return int(pd.Timedelta(delay) / pd.Timedelta(milliseconds=1))


def _copies():
    """A function of its own with all it needs, so that executors need not have this package."""

    def unpacked(kept: bytes) -> dict[str, tuple[str | None, int]]:
        return {key: (held, until) for key, held, until in json.loads(zlib.decompress(bytes(kept)))}

    def packed(known: dict[str, tuple[str | None, int]]) -> bytes:
        return zlib.compress(json.dumps([(key, *value) for key, value in known.items()]).encode(), 1)

    def run(bucket: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        # per key its first record, None once it has repeated, and the time up to which it is known
        known = unpacked(state.get[0]) if state.exists else {}
        now = state.getCurrentWatermarkMs()
        # a key with rows in this call lives on, whatever its time; the others end behind the watermark
        ended = {key for key, (_, until) in known.items() if until < now}
        for batch in () if state.hasTimedOut else batches:
            found = []
            for key, record, until in zip(batch["key"], batch["record"], batch["until"]):
                until = max(int(until), now + 1, 1)
                if key not in known:
                    known[key] = (record, until)
                    continue
                ended.discard(key)
                held, before = known[key]
                found += [record] if held is None else [held, record]
                known[key] = (None, max(before, until))
            if found:
                yield pd.DataFrame({"record": found})
        for key in ended:
            del known[key]
        if not known:
            state.remove()
            return
        state.update((packed(known),))
        state.setTimeoutTimestamp(min(until for _, until in known.values()))

    return run


def _key_text(keys: Sequence[Column]) -> Column:
    """One text per key; both zeros of a double are one value, as in a grouping."""
    return F.to_json(F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)]), JSON)


def all_copies(
    stream: DataFrame, keys: Sequence[str], time_column: str, delay: str, buckets: int = BUCKETS
) -> DataFrame:
    """All rows whose key comes more than once within ``delay`` (say ``10 days``) of its last copy.

    The state of a key is its first row, held back until a second one comes, then
    only the note that it repeats: one record a key, whatever the number of copies.
    It ends when the watermark passes the latest copy's time by ``delay``.  Rows of
    a key pass one task batch by batch and are not gathered.

    Keys share ``buckets`` states, so a micro-batch calls Python at most once a
    bucket, not once a key; it rewrites the states of the buckets it has rows of.

    Keys compare as they are, and NULL key parts equal each other.  A row without a
    time takes part and prolongs nothing; if it is a key's only one so far, it is
    forgotten with the next advance of the watermark.  Rows later than the watermark are dropped
    by Spark; ``ledger.count_windows`` counts such rows.
    """
    rows = watched(stream, time_column, delay)
    record = F.to_json(F.struct(*[named(c) for c in rows.columns]), JSON).alias("record")
    until = F.unix_millis(F.col(time_column).cast("timestamp")) + _milliseconds(delay)
    kinds = dict(rows.dtypes)
    values = [F.when(named(k) == 0, F.lit(0.0)).otherwise(named(k)) if kinds[k] in ("float", "double") else named(k) for k in keys]
    keyed = rows.select(
        named(time_column).alias("__watched"), _key_text(values).alias("key"), record, F.coalesce(until, F.lit(0)).alias("until")
    )
    wide = keyed.withColumn("__bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
    found = wide.groupBy("__bucket").applyInPandasWithState(_copies(), OUT, STATE, "append", GroupStateTimeout.EventTimeTimeout)
    back = found.select(F.from_json("record", rows.schema, JSON).alias("row")).select("row.*")
    return back.select(*[named(f.name).cast(f.dataType).alias(f.name) for f in stream.schema])
