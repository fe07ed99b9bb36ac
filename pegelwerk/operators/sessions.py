"""Sessions from a Cartesian tree over the pauses between an entity's events.

The inner nodes of the tree are the pauses, the longest on top; the leaves are the
events.  A node's subtree is a run of events without a longer pause inside.  For any
threshold the sessions are the subtrees whose own longest pause does not exceed it
while the pause above does: one filter (``cut``) on the node table, which serves every
gap setting without building anything again.

No task holds an entity.  Its events are cut into chunks of time; a task streams the
chunks it has, sorted by time, through one stack, and passes on what the chunk decides.
Only the spines stay open (subtrees that touch the chunk's border and have the greater
pause there); they are merged over neighbouring chunks by the same stack, in a fixed
number of rounds.  It is one chain: nodes that are decided go through the later rounds
untouched, so nothing is computed twice.

Bound: pauses along a spine grow or fall strictly (equal ones become one node), so k
open pieces of a side need k * k / 2 ms.  A chunk of a day leaves at most 13,145 pieces
a side, the whole of eleven years 833,000, however many events there are; the stack is
no longer than that either.  Pauses in any usual order leave about their logarithm.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pegelwerk.operators.instants import _whole

#: The pause between neighbours that never belong together.
NEVER = 9_000_000_000_000_000_000
#: The longest pause inside a single event.
LEAF = -1
#: The pause before a chunk's first piece, as long as nobody knows it: lower than any.
UNKNOWN = -1

_NODE = ["start_ms", "end_ms", "events", "best_value", "best_start", "best_key"]
_LOW = float("-inf")


def _better(a: list, b: list) -> list:
    """The louder of two pieces' (value, start, key): null is lowest, the earlier wins, then the smaller key."""
    va, vb = _LOW if a[5] is None else a[5], _LOW if b[5] is None else b[5]
    if va != vb:
        return a[5:8] if va > vb else b[5:8]
    return a[5:8] if (a[6], a[7]) <= (b[6], b[7]) else b[5:8]


class Stack:
    """Cartesian trees over neighbouring pieces [before, gap, start, end, events, value, best start, best key, limit], in order of time.

    A piece is a subtree with the longest inner pause ``gap``; ``before`` is the pause to its
    predecessor.  ``closed`` gets nodes (gap, upper_gap, *node) whose shorter outer pause, ``upper_gap``,
    is known; ``left`` and the stack hold pieces that wait for a pause outside of these.
    """

    def __init__(self, closed: list):
        self.closed, self.left, self.stack = closed, [], []  # stack: pauses before each piece fall from bottom to top

    def settle(self, pause: int) -> None:
        """The pause after the last piece: pieces with a shorter one before them are decided."""
        stack, closed = self.stack, self.closed
        while stack and stack[-1][0] <= pause:
            high = stack.pop()
            gap = high[0]
            if stack or self.left and self.left[-1][0] == gap:
                # the pause before it is the shorter one, or as short: it is the node above both
                low = stack[-1] if stack else self.left[-1]
                if low[1] < gap:
                    closed.append((low[1], gap, *low[2:]))
                if high[1] < gap:
                    closed.append((high[1], gap, *high[2:]))
                best = _better(low, high)
                low[1], low[3], low[4] = gap, high[3], low[4] + high[4]
                low[5:8] = best
            elif gap >= NEVER:
                closed.append((high[1], NEVER, *high[2:]))
            else:
                self.left.append(high)

    def push(self, piece: list) -> None:
        self.settle(piece[0])
        self.stack.append(piece)

    def open(self) -> list:
        return self.left + self.stack


def forest(pieces: Sequence, end: int | None = None) -> tuple[list, list]:
    """(closed, open) of a whole sequence; ``end`` is the pause after its last piece, None if it isn't known yet."""
    s = Stack([])
    for p in pieces:
        s.push(list(p))
    if end is not None:
        s.settle(end)
    return s.closed, s.open()


def _round(names: list[str], last: bool, settings: list[int] | None):
    """A mapInArrow function over pieces sorted by ``names``, chunk, start and order; rows already closed pass."""
    from bisect import bisect_left

    import pyarrow as pa
    import pyarrow.compute as pc

    piece = ["_before", "gap", *_NODE, "_limit"]
    made = {"_before": pa.int64(), "gap": pa.int64(), "upper_gap": pa.int64(), "best_value": pa.float64(), "best_start": pa.int64(), "best_key": pa.string(), "_limit": pa.string()}

    def wanted(x: tuple) -> bool:
        """Some setting cuts this node: gap <= setting < upper gap."""
        k = bisect_left(settings, x[0])
        return k < len(settings) and settings[k] < x[1]

    def run(batches):
        schema = key = end = limit = None
        stack, rows, of = Stack([]), [], []

        def finish():
            """The chunk is over: what it decided, and what stays open (upper_gap is null)."""
            if last:
                stack.settle(NEVER)
            done = [x for x in stack.closed if settings is None or wanted(x)]
            left = stack.open()
            rows.extend((None, x[0], x[1], *x[2:9], 0) for x in done)
            rows.extend((None if p[0] == UNKNOWN else p[0], p[1], None, *p[2:9], k) for k, p in enumerate(left))
            of.append((key, len(done) + len(left)))

        def flush():
            out = {n: pa.array(c, made.get(n, pa.int64())) for n, c in zip(["_before", "gap", "upper_gap", *_NODE, "_limit", "_seq"], zip(*rows))}
            at = pa.array([j for j, (_, m) in enumerate(of) for _ in range(m)], pa.int64())
            for i, n in enumerate((*names, "_chunk")):
                out[n] = pa.array([k[i] for k, _ in of], schema.field(n).type).take(at)
            rows.clear()
            of.clear()
            return pa.RecordBatch.from_arrays([out[n] for n in schema.names], schema=schema)

        for batch in batches:
            schema = batch.schema
            closed = pc.is_valid(batch.column("upper_gap"))
            if pc.any(closed).as_py():
                yield batch.filter(closed)
                batch = batch.filter(pc.invert(closed))
            get = lambda n: batch.column(n).to_pylist()
            for k, *p in zip(zip(*map(get, (*names, "_chunk"))), *map(get, piece)):
                if k != key:
                    if key is not None:
                        finish()
                        if len(rows) >= 20_000:
                            yield flush()
                    key, stack, p[0] = k, Stack([]), NEVER if last else UNKNOWN if p[0] is None else p[0]
                elif p[0] is None:
                    p[0] = p[2] - end if p[8] is not None and p[8] == limit else NEVER
                end, limit = p[3], p[8]
                stack.push(p)
        if key is not None:
            finish()
        if rows:
            yield flush()

    return run


def session_tree(
    events: DataFrame,
    keys: list[str],
    t_ms: str,
    event: str,
    value: str,
    limit: str | None = None,
    chunk_ms: int = 86_400_000,
    fan_in: int = 64,
    settings: list[int] | None = None,
) -> DataFrame:
    """events -> one row per node: keys, gap, upper_gap, start_ms, end_ms, events, best_key, best_value.

    ``event`` is a string that names the event, ``value`` what the best event is highest in (null
    and NaN are lowest).  Neighbours with different or null ``limit`` never belong together.  With
    ``settings`` only nodes that one of these thresholds cuts are kept.  Rows with a null key,
    instant or event are dropped; several rows of one event must have been made one before.
    """
    t, x = F.col(t_ms).cast("long"), F.col(value).cast("double")
    none = F.lit(None).cast("long")
    names = [f"_k{i}" for i in range(len(keys))]
    part = events.dropna(subset=[*keys, t_ms, event]).select(
        *[F.col(k).alias(n) for k, n in zip(keys, names)],
        _whole(t, chunk_ms).alias("_chunk"),
        F.lit(0).cast("long").alias("_seq"),
        none.alias("_before"),
        F.lit(LEAF).cast("long").alias("gap"),
        none.alias("upper_gap"),
        t.alias("start_ms"),
        t.alias("end_ms"),
        F.lit(1).cast("long").alias("events"),
        F.when(~F.isnan(x), x).alias("best_value"),
        t.alias("best_start"),
        F.col(event).cast("string").alias("best_key"),
        (F.col(limit).cast("string") if limit else F.lit("")).alias("_limit"),
    )
    keep = None if settings is None else sorted(settings)
    coarser = (F.col("_chunk"), _whole(F.col("_chunk"), fan_in), F.lit(0).cast("long"))
    for chunk, last in zip(coarser, (False, False, True)):
        # closed rows keep their chunk: a place to go that isn't hot
        part = part.withColumn("_chunk", F.when(F.col("upper_gap").isNull(), chunk).otherwise(F.col("_chunk")))
        part = part.repartition(*names, "_chunk").sortWithinPartitions(*names, "_chunk", "start_ms", "_seq", "best_key")
        part = part.mapInArrow(_round(names, last, keep), part.schema)
    return part.select(*[F.col(n).alias(k) for k, n in zip(keys, names)], "gap", "upper_gap", "start_ms", "end_ms", "events", "best_key", "best_value")


def cut(tree: DataFrame, gap_ms: int) -> DataFrame:
    """The sessions for one threshold: neighbours at most ``gap_ms`` apart belong together."""
    return tree.filter((F.col("gap") <= gap_ms) & (F.col("upper_gap") > gap_ms)).drop("gap", "upper_gap")
