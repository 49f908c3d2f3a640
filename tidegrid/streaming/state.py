"""T-7 with keyed state: a processor per (device, tile) in the state store.

The state of a tile is its events, packed in order.  A batch brings a tile new events, wherever in time; the processor merges them, resolves the tile
again and returns the rows that are new or changed: those behind a late event, up to where the value in force is the same as before.
Beside them it returns what the tile hands on, its last basal rate and dose.  What a tile receives from earlier ones is folded from
those one-row summaries when the result is read.

State lives as long as ``keep`` says (for ever by default).  A tile that starts without state is marked; if the table already has rows of it, its
state had expired, and its rows are resolved from the table and the batch together (``streaming.jobs``).

Rows come and go as rows: most tiles get a handful per batch, and a pandas frame of each costs far more than the work on it.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Row
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidegrid.tiles import TILE

NO_NUMBER = -(2**63)  # stands for a missing sequence number in the state, where numbers are compared
OUTPUT = T.StructType(
    [
        T.StructField("pump_serial", T.LongType()),
        T.StructField(TILE, T.LongType()),
        T.StructField("us", T.LongType()),  # microseconds; null: the row is what the tile hands on
        T.StructField("seq_num", T.LongType()),
        T.StructField("copy", T.LongType()),
        T.StructField("stream", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("basal_rate", T.DoubleType()),
        T.StructField("dose_us", T.LongType()),
        T.StructField("fresh", T.BooleanType()),
    ]
)
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def tile_processor(keep_ms: int | None = None) -> StatefulProcessor:
    """The processor; its class is local, so that workers get it by value."""
    stored = "ts array<bigint>, seq array<bigint>, stream array<string>, value array<double>"
    made = Row(*OUTPUT.fieldNames())

    class TileProcessor(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.events = handle.getValueState("events", stored, keep_ms)

        def handleInputRows(self, key, rows, timer_values) -> Iterator:
            state = self.events.get()
            fresh = state is None
            old = [] if fresh else list(zip(*state, strict=True))
            # a value that is no number counts as missing
            new = [(r.us, r.seq_num, r.stream, r.value if r.value == r.value else None) for r in rows]

            def place(event):
                us, seq, stream, value = event
                return us, seq, stream or "", value is not None, value or 0.0

            def resolved(events):
                out, rate, dose, last, copy = {}, None, None, None, 0
                for event in sorted(events, key=place):
                    us, seq, stream, value = event
                    copy = copy + 1 if (us, seq) == last else 0
                    last = (us, seq)
                    if stream == "basal" and value is not None:
                        rate = value
                    if stream == "bolus" and value is not None and value > 0:
                        dose = us
                    out[us, seq, copy] = (stream, value, rate, dose)
                return out, (rate, dose)

            before, handed = resolved(old)
            after, hands = resolved([*old, *new])
            self.events.update(tuple(list(c) for c in zip(*sorted([*old, *new], key=place), strict=True)))
            for at, row in after.items():
                if before.get(at) != row:
                    yield made(*key, *at, *row, fresh)
            if hands != handed or fresh:
                yield made(*key, None, None, None, None, None, *hands, fresh)

        def close(self) -> None:
            pass

    return TileProcessor()
