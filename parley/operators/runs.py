"""Conversations of any length as runs of turns, and what came before each run.

A conversation that holds half of all turns cannot be one row or one task. Turns
are sorted over the cluster by conversation and turn, and each task packs what it
has into runs of bounded bytes. What a run must know of the runs before it
(how many turns, whether the talk has ended) is a prefix sum: tasks add up
their own rows as they pass, and of each task only its first and last
conversation go on to the next.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.constants import CHAT_SYSTEM_PROMPT, SYSTEM, USER
from parley.functions.text import strip
from parley.session import materialize

#: Bytes of a run's turns; a longer turn is a run of its own.
RUN_BYTES = 1 << 20


def rejected_turns(df: DataFrame, conversation: str | Sequence[str]) -> DataFrame:
    """The rows that folding leaves out, as they belong to no conversation, with the names of the columns that are null."""
    keys = [conversation] if isinstance(conversation, str) else list(conversation)
    missing = F.array_compact(F.array(*(F.when(F.col(k).isNull(), F.lit(k)) for k in keys)))
    return df.withColumn("missing", F.array_join(missing, ",")).where(F.col("missing") != "")


def _breaks(columns: Sequence[pa.Array]) -> np.ndarray:
    """Whether each row but the first differs from the one before, in any of some columns without nulls."""
    out = np.zeros(max(0, len(columns[0]) - 1), bool)
    for c in columns:
        out |= pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False)
    return out


def _packer(keys: list[str], fields: list[str], sums: list[str], firsts: list[str], name: str, run_bytes: int):
    """Rows in order, as runs: no run crosses a conversation's end or a batch's, or begins beyond ``run_bytes`` of the last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        last: tuple | None = None
        held = {"run": 0, "before": 0, **dict.fromkeys(sums, 0)}
        first_values: dict[str, object] = {}
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            c = {x: batch.column(i) for i, x in enumerate(batch.schema.names)}
            new = np.r_[True, _breaks([c[k] for k in keys])]
            size = np.full(n, 16, np.int64)
            for f in fields:
                if pa.types.is_string(c[f].type) or pa.types.is_large_string(c[f].type):
                    size += pc.fill_null(pc.binary_length(c[f]), 0).to_numpy(zero_copy_only=False)
            begun = np.maximum.accumulate(np.where(new, np.arange(n), 0))
            upto = np.cumsum(size)
            block = (upto - size - (upto - size)[begun]) // run_bytes
            starts = np.flatnonzero(new | np.r_[False, block[1:] != block[:-1]])
            stops = np.r_[starts[1:], n]
            running = {s: np.r_[0, np.cumsum(c[s].to_numpy(zero_copy_only=False))] for s in sums}
            out = {x: [] for x in (*held, *firsts)}
            for a, b in zip(starts.tolist(), stops.tolist(), strict=True):
                if new[a]:
                    here = tuple(c[k][a].as_py() for k in keys)
                    if here != last:
                        last, held = here, dict.fromkeys(held, 0)
                        first_values = {f: c[f][a].as_py() for f in firsts}
                for x, v in {**held, **first_values}.items():
                    out[x].append(v)
                held["run"] += 1
                held["before"] += b - a
                for s in sums:
                    held[s] += int(running[s][b] - running[s][a])
            turns = pa.StructArray.from_arrays([c[f] for f in fields], fields)
            lists = pa.ListArray.from_arrays(pa.array(np.r_[starts, n], pa.int32()), turns)
            own = [pa.array(out[x], pa.int64()) for x in held] + [pa.array(out[f], c[f].type) for f in firsts]
            # After the run, for what the next task carries on.
            after = [pa.array(running[s][stops] - running[s][starts], pa.int64()) for s in sums]
            places = [pa.array(np.full(len(starts), part), pa.int32()), pa.array(np.arange(number, number + len(starts)), pa.int64())]
            columns = [*(c[k].take(pa.array(starts)) for k in keys), *places, *own, *after, lists]
            names = [*keys, "_part", "_place", *held, *firsts, *(f"_in_{s}" for s in sums), name]
            yield pa.record_batch(columns, names)
            number += len(starts)

    return run


def fold_runs(
    df: DataFrame,
    conversation: str | Sequence[str],
    turn: str,
    fields: Mapping[str, str],
    name: str = "turns",
    sums: Mapping[str, Column] | None = None,
    firsts: Mapping[str, Column] | None = None,
    run_bytes: int = RUN_BYTES,
) -> DataFrame:
    """Conversations as runs of turns, each of ``run_bytes`` or so: the list ``name`` of structs, in order.

    Columns: the conversation, ``run`` (0, 1, 2 ...), ``before`` (turns in earlier runs), the list, and what the whole
    numbers ``sums`` of all turns in earlier runs add up to, and ``firsts`` of the conversation's first turn.
    Turns with equal numbers come in the order of their fields' hash; null numbers first. Rows without a
    conversation are left out: ``rejected_turns`` has them. A conversation spreads over as many tasks as its turns
    need; the driver sees one row a task.
    """
    keys = [conversation] if isinstance(conversation, str) else list(conversation)
    sums, firsts = dict(sums or {}), dict(firsts or {})
    rows = df.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys)).select(
        *keys,
        F.col(turn).alias("_turn"),
        F.xxhash64(*fields).alias("_tie"),
        # Rows equal in everything may change places, and may go to several tasks.
        F.pmod(F.monotonically_increasing_id(), F.lit(64)).alias("_copy"),
        *(F.col(c).alias(f"_f_{f}") for c, f in fields.items()),
        *(v.cast("bigint").alias(f"_s_{s}") for s, v in sums.items()),
        *(v.alias(f"_v_{s}") for s, v in firsts.items()),
    )
    order = [*keys, "_turn", "_tie", "_copy"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("_turn", "_tie", "_copy")
    element = T.StructType([T.StructField(f"_f_{f}", df.schema[c].dataType) for c, f in fields.items()])
    schema = T.StructType([df.schema[k] for k in keys]).add("_part", "integer").add("_place", "long").add("run", "long").add("before", "long")
    for s in sums:
        schema = schema.add(f"_s_{s}", "long")
    for s in firsts:
        schema = schema.add(f"_v_{s}", rows.schema[f"_v_{s}"].dataType)
    for s in sums:
        schema = schema.add(f"_in__s_{s}", "long")
    pack = _packer(keys, [f"_f_{f}" for f in fields.values()], [f"_s_{s}" for s in sums], [f"_v_{s}" for s in firsts], name, run_bytes)
    runs = materialize(ordered.mapInArrow(pack, schema.add(name, T.ArrayType(element))), "runs")
    carried = _carried(runs, keys, list(sums), list(firsts), name)
    on = [runs["_part"] == carried["_at"], *(runs[k] == carried[f"_k_{k}"] for k in keys)]
    joined = runs.join(F.broadcast(carried), on, "left")

    def whole(column: str) -> Column:
        return F.col(column) + F.coalesce(F.col(f"_c_{column}"), F.lit(0))

    follows = F.col("_at").isNotNull()
    return joined.select(
        *keys,
        whole("run").alias("run"),
        whole("before").alias("before"),
        *(whole(f"_s_{s}").alias(s) for s in sums),
        *(F.when(follows, F.col(f"_c__v_{s}")).otherwise(F.col(f"_v_{s}")).alias(s) for s in firsts),
        F.transform(name, lambda t: F.struct(*(t[f"_f_{f}"].alias(f) for f in fields.values()))).alias(name),
    )


def _carried(runs: DataFrame, keys: list[str], sums: list[str], firsts: list[str], name: str) -> DataFrame:
    """For each task whose first conversation began in an earlier task, what the earlier tasks' runs of it come to."""
    spark = runs.sparkSession
    counted = {"run": F.lit(1), "before": F.size(name), **{f"_s_{s}": F.col(f"_in__s_{s}") for s in sums}}
    state = F.struct(
        *(F.col(k) for k in keys),
        *((F.col(c) + v).cast("bigint").alias(c) for c, v in counted.items()),
        *(F.col(f"_v_{s}") for s in firsts),
    )
    ends = runs.groupBy("_part").agg(F.min_by(F.struct(*keys), "_place").alias("head"), F.max_by(state, "_place").alias("tail"))
    out, carry = [], None
    for r in sorted(ends.collect(), key=lambda r: r["_part"]):  # one row a task
        head = [r["head"][k] for k in keys]
        tail = r["tail"].asDict()
        follows = carry is not None and [carry[k] for k in keys] == head
        if follows:
            out.append((r["_part"], *head, *(carry[c] for c in counted), *(carry[f"_v_{s}"] for s in firsts)))
            if [tail[k] for k in keys] == head:
                tail.update({c: tail[c] + carry[c] for c in counted}, **{f"_v_{s}": carry[f"_v_{s}"] for s in firsts})
        carry = tail
    schema = T.StructType().add("_at", "integer")
    for k in keys:
        schema = schema.add(f"_k_{k}", runs.schema[k].dataType)
    for c in counted:
        schema = schema.add(f"_c_{c}", "long")
    for s in firsts:
        schema = schema.add(f"_c__v_{s}", runs.schema[f"_v_{s}"].dataType)
    return spark.createDataFrame(out, schema)


def unfold_runs(df: DataFrame, name: str = "turns", turn: str = "turn") -> DataFrame:
    """One row a turn again, numbered from 0 in its conversation over all runs; no shuffle."""
    kept = [c for c in df.columns if c not in (name, "run", "before")]
    rows = df.select(*kept, "before", F.posexplode(name).alias(turn, "_turn"))
    return rows.select(*kept, (F.col("before") + F.col(turn)).alias(turn), "_turn.*")


def chat_runs(
    df: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    system: str = CHAT_SYSTEM_PROMPT,
    run_bytes: int = RUN_BYTES,
) -> DataFrame:
    """Chat histories over runs of turns: the compact form of ``chat_history``, where no row holds a whole conversation.

    One row a run, as far as the talk goes: its ``messages``, the place of the first of them in the chat (``first``, from 1),
    and ``points``: for each of its user turns up to which message of the chat its history goes. The chat
    begins with ``system`` unless its first turn is a system turn, and ends before the first blank user turn, in whichever run that is.
    """
    stripped = F.coalesce(strip(F.col(text)), F.lit(""))
    clean = df.withColumn(text, stripped)
    ends = F.coalesce(((F.col(role) == USER) & (F.col(text) == "")).cast("int"), F.lit(0))
    fields = {turn: "at", role: "role", text: "content"}
    runs = fold_runs(clean, conversation, turn, fields, "_turns", {"_ended": ends}, {"_opening": F.col(role)}, run_bytes)
    stop = F.array_position(F.transform("_turns", lambda t: (t["role"] == USER) & (t["content"] == "")), True)
    heard = F.when(stop > 0, F.slice("_turns", F.lit(1), stop.cast("int") - 1)).otherwise(F.col("_turns"))
    own = F.coalesce(F.col("_opening") == SYSTEM, F.lit(False))
    told = runs.where("_ended = 0").select(conversation, "run", "before", heard.alias("_turns"), own.alias("_own"))
    said = F.transform("_turns", lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content")))
    opening = F.array(F.struct(F.lit(SYSTEM).alias("role"), F.lit(system).alias("content")))
    opens = (F.col("run") == 0) & ~F.col("_own")
    shift = F.when(F.col("_own"), 0).otherwise(1)
    points = F.filter(
        F.transform(
            "_turns",
            lambda t, i: F.struct(
                t["at"].alias(turn), (F.col("before") + i + shift + 1).alias("upto"), (t["role"] == USER).alias("user")
            ),
        ),
        lambda p: p["user"],
    )
    return told.select(
        conversation,
        "run",
        (F.col("before") + F.when(opens, 1).otherwise(shift + 1)).alias("first"),
        F.when(opens, F.concat(opening, said)).otherwise(said).alias("messages"),
        F.transform(points, lambda p: F.struct(p[turn].alias(turn), p["upto"].alias("upto"))).alias("points"),
    )
