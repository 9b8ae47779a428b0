"""Transcript parsing with a hidden Markov model, and canonical rendering of the turns found.

States are (role, first line of a turn or a later one). Each line shows one symbol made of its speaker
marker, its length, its end and whether it follows a blank line. Starts, transitions and symbols are counted
on labelled lines; Viterbi recovers the states, and turns are rendered in one canonical form.

Source texts are dealt by ranges of (conversation, order), so a conversation of any length spreads over tasks.
Where one goes on in the next range, each range gives the best scores from state to state over its part; chained,
they say in which state each part begins and ends, and the parts are decoded as the uncut text would be.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from helio.llm.common import cut

#: Speaker markers at the start of a line, by the role they hint at. A hyphen counts only before a space.
MARKERS = {
    "user": r"(?i)^\s*(user|human|question|q|customer|prompter)\s*([:>]|-(?=\s))\s*",
    "assistant": r"(?i)^\s*(assistant|ai|bot|answer|a|agent|model)\s*([:>]|-(?=\s))\s*",
    "system": r"(?i)^\s*(system|instructions?|context)\s*([:>]|-(?=\s))\s*",
    "other": r"^\s*(\S{1,20}\s*:\s|>>+\s*|###+\s*)",
}
ROLES = ("system", "user", "assistant")
LENGTHS = (40, 80, 160, 320, 640)


def symbol(line: Column, after_blank: Column) -> Column:
    """The line's symbol, as text: marker|length class|end|after a blank line."""
    marker = F.lit("none")
    for name in reversed(MARKERS):
        marker = F.when(line.rlike(MARKERS[name]), name).otherwise(marker)
    length = F.lit(str(len(LENGTHS)))
    for k in reversed(range(len(LENGTHS))):
        length = F.when(F.char_length(line) < LENGTHS[k], str(k)).otherwise(length)
    end = F.when(line.rlike(r"\?\s*$"), "q").otherwise("-")
    return F.concat_ws("|", marker, length, end, after_blank.cast("string"))


def transcript_rows(turns: DataFrame, conv_col: str = "conv_id", order_col: str = "turn", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per source text: conv, order, lines, symbols (of the lines) and ``carry``. A null text is one empty line."""
    rows = turns.select(F.col(conv_col).alias("conv"), F.col(order_col).alias("order"), *carry, F.split(F.coalesce(F.col(text_col), F.lit("")), "\n").alias("lines"))
    blank = lambda i: (i > 0) & (F.trim(F.get("lines", i - 1)) == "")
    return rows.withColumn("symbols", F.transform("lines", lambda x, i: symbol(x, blank(i))))


def count_model(rows: DataFrame, role_col: str = "role") -> dict:
    """Count starts, transitions and symbols on labelled source texts; at most states * (states + symbols) counts, however many texts there are.

    The role before a text is that at order - 1 of the same conversation; texts that repeat a place, and roles
    outside ROLES, count once and not at all.
    """
    known = rows.where(F.col(role_col).isin(*ROLES)).select("conv", "order", F.col(role_col).alias("role"), "symbols")
    lines = known.select("role", F.posexplode("symbols").alias("line_no", "symbol"))
    shown = lines.groupBy("role", (F.col("line_no") == 0).alias("first"), "symbol").count().collect()
    places = known.select("conv", "order", "role").distinct()
    before = places.select("conv", (F.col("order") + 1).alias("order"), F.col("role").alias("before"))
    moves = places.join(before, ["conv", "order"], "left").groupBy("before", "role").count().collect()
    return {"shown": [tuple(r) for r in shown], "moves": [tuple(r) for r in moves]}


def _matrices(model: dict) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray], np.ndarray]:
    n = len(ROLES)
    state = lambda role, first: 2 * ROLES.index(role) + (not first)
    show = {}
    totals = np.full(2 * n, 1.0)
    for role, first, sym, count in model["shown"]:
        show.setdefault(sym, np.full(2 * n, 0.1))[state(role, first)] += count
        totals[state(role, first)] += count
    start, move = np.full(2 * n, 1e-3), np.full((2 * n, 2 * n), 1e-3)
    for s in range(n):
        start[2 * s] += 1
    ends = np.full(n, 1.0)
    for before, role, count in model["moves"]:
        if before is None:
            start[state(role, True)] += count
        else:
            ends[ROLES.index(before)] += count
            for later in (0, 1):
                move[2 * ROLES.index(before) + later, state(role, True)] += count
    for s in range(n):  # lines that go on in the same turn
        inner = sum(c for role, first, _, c in model["shown"] if role == ROLES[s] and not first)
        move[2 * s, 2 * s + 1] += inner / 2
        move[2 * s + 1, 2 * s + 1] += inner / 2
    return np.log(start / start.sum()), np.log(move / move.sum(1, keepdims=True)), {k: np.log(v / totals) for k, v in show.items()}, np.log(0.1 / totals)


def viterbi(symbols: list[str], start: np.ndarray, move: np.ndarray, show: dict, unseen: np.ndarray, enter: int | None = None, end: int | None = None) -> list[int]:
    """The likeliest states; of equal ones the first. Empty for no symbols. ``enter`` is the state before them, ``end`` their last one, where these are known."""
    if not symbols:
        return []
    best = (start if enter is None else move[enter]) + show.get(symbols[0], unseen)
    back = []
    for s in symbols[1:]:
        paths = best[:, None] + move
        at = paths.argmax(0)
        back.append(at)
        best = paths[at, np.arange(len(at))] + show.get(s, unseen)
    out = [int(best.argmax()) if end is None else end]
    for at in reversed(back):
        out.append(int(at[out[-1]]))
    return out[::-1]


def transfer(symbols: list[str], move: np.ndarray, show: dict, unseen: np.ndarray) -> np.ndarray:
    """Best scores over the symbols, from each state before them to each last one."""
    total = None
    for s in symbols:
        step = move + show.get(s, unseen)
        total = step if total is None else (total[:, :, None] + step[None]).max(1)
    return total


def chained(parts: list[np.ndarray]) -> list[tuple[int | None, int]]:
    """The state before and the last state of each part of one text; the first part's scores are a vector, the others' are from ``transfer``."""
    reached = [parts[0]]
    for m in parts[1:]:
        reached.append((reached[-1][:, None] + m).max(0))
    ends = [int(reached[-1].argmax())]
    for a, m in zip(reached[-2::-1], parts[:0:-1], strict=True):
        ends.append(int((a + m[:, ends[-1]]).argmax()))
    ends.reverse()
    return [(None, ends[0]), *zip(ends[:-1], ends[1:], strict=True)]


def _runs(batches):
    """(conv, part, lines, symbols) of each run of one conversation in sorted batches."""
    now, part, lines, symbols = None, None, [], []
    for batch in batches:
        for c, p, ls, ss in zip(*(batch.column(n).to_pylist() for n in ("conv", "part", "lines", "symbols")), strict=True):
            if lines and c != now:
                yield now, part, lines, symbols
                lines, symbols = [], []
            now, part = c, p
            lines += ls
            symbols += ss
    if lines:
        yield now, part, lines, symbols


def _turns(states: list[int], lines: list[str], symbols: list[str], enter: int | None) -> list[tuple[int, str, list[str]]]:
    """(number, role, lines); number -1 goes on with the turn before. A turn's first line loses its marker if that names its role."""
    role_now, number, out = None if enter is None else enter // 2, -1, []
    for state, line, sym in zip(states, lines, symbols, strict=True):
        role = ROLES[state // 2]
        if state % 2 == 0 or state // 2 != role_now:
            number += 1
            out.append((number, role, []))
        elif not out:
            out.append((-1, role, []))
        role_now = state // 2
        opens = state % 2 == 0 and sym.startswith(role + "|")
        out[-1][2].append(re.sub(MARKERS[role], "", line, count=1, flags=re.ASCII) if opens else line)
    return out


def parse_transcripts(rows: DataFrame, model: dict) -> DataFrame:
    """One row per turn found: conv, turn_no, role, text, rendered.

    ``rows`` as from ``transcript_rows``, roles unknown. Texts at equal places are ordered by a hash of their
    lines, null orders come first, and texts with a null conversation are one conversation; an empty table gives no rows.
    rendered: ``<|role|>``, a line break, the text without its marker, ``<|end|>``.
    """
    matrices = _matrices(model)
    start, move, show, unseen = matrices
    spark = rows.sparkSession
    keys = ["conv", "order", "_tie", "_row"]
    dealt = rows.select("conv", "order", "lines", "symbols", F.xxhash64("lines").alias("_tie"), F.monotonically_increasing_id().alias("_row"))
    dealt = cut(dealt.repartitionByRange(*keys).sortWithinPartitions(*keys).select("conv", "lines", "symbols", F.spark_partition_id().alias("part")))
    # Two rows for each range at most: the first and the last conversation in it.
    name = F.struct(F.col("conv").isNotNull().alias("known"), "conv")
    edges = sorted((r["part"], tuple(r["lo"])[1], tuple(r["hi"])[1]) for r in dealt.groupBy("part").agg(F.min(name).alias("lo"), F.max(name).alias("hi")).collect())
    spread: dict = {}
    for (p, _, hi), (q, lo, _) in zip(edges, edges[1:], strict=False):
        if hi == lo:
            spread.setdefault(hi, [p]).append(q)
    kind, conv_type = dealt.schema["conv"].dataType.simpleString(), to_arrow_type(dealt.schema["conv"].dataType)
    at: dict = {}
    if spread:
        parts_of = spark.sparkContext.broadcast(spread)

        def scores(batches):
            for conv, part, _, symbols in _runs(batches):
                first = parts_of.value[conv][0] == part
                m = transfer(symbols[first:], move, show, unseen)
                if first:
                    a = start + show.get(symbols[0], unseen)
                    m = a if m is None else (a[:, None] + m).max(0)
                yield pa.RecordBatch.from_arrays([pa.array([conv], conv_type), pa.array([part], pa.int32()), pa.array([m.ravel().tolist()], pa.list_(pa.float64()))], ["conv", "part", "m"])

        ends = sorted({(p, c) for c, ps in spread.items() for p in ps}, key=lambda x: x[0])
        wanted = F.broadcast(spark.createDataFrame(ends, f"part int, conv {kind}").select(F.col("part").alias("_p"), F.col("conv").alias("_c")))
        found = dealt.join(wanted, (F.col("part") == F.col("_p")) & F.col("conv").eqNullSafe(F.col("_c"))).select("conv", "part", "lines", "symbols")
        got = {(r["conv"], r["part"]): np.array(r["m"]) for r in found.mapInArrow(scores, f"conv {kind}, part int, m array<double>").collect()}
        n = 2 * len(ROLES)
        for conv, ps in spread.items():
            parts = [got[conv, p] if k == 0 else got[conv, p].reshape(n, n) for k, p in enumerate(ps)]
            at |= {(conv, p): states for p, states in zip(ps, chained(parts), strict=True)}
        parts_of.unpersist()
    known = spark.sparkContext.broadcast((matrices, at))

    def parse(batches):
        (start, move, show, unseen), at = known.value
        out: list[tuple] = []
        size = 0
        for conv, part, lines, symbols in _runs(batches):
            enter, end = at.get((conv, part), (None, None))
            states = viterbi(symbols, start, move, show, unseen, enter, end)
            spans = (conv, part) in at
            out += [(conv, part, k, role, "\n".join(ls), spans) for k, role, ls in _turns(states, lines, symbols, enter)]
            size += sum(map(len, lines))
            if size > 4_000_000:
                yield table(out)
                out, size = [], 0
        if out:
            yield table(out)

    names = ["conv", "part", "turn_no", "role", "text", "spans"]

    def table(found):
        kinds = [conv_type, pa.int32(), pa.int64(), pa.string(), pa.string(), pa.bool_()]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*found, strict=True), kinds, strict=True)], names)

    turns = dealt.mapInArrow(parse, f"conv {kind}, part int, turn_no long, role string, text string, spans boolean")
    if at:
        turns = cut(turns)
        # Turns opened in the ranges before; a row for each range and spread conversation.
        opened = turns.where("spans").groupBy("conv", "part").agg(F.count_if(F.col("turn_no") >= 0).alias("_n"))
        before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        base = opened.select(F.col("conv").alias("_c"), F.col("part").alias("_p"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
        spread_turns = turns.where("spans").join(F.broadcast(base), (F.col("part") == F.col("_p")) & F.col("conv").eqNullSafe(F.col("_c")))
        pieces = F.array_sort(F.collect_list(F.struct("part", "text")))
        whole = spread_turns.groupBy("conv", (F.col("_base") + F.col("turn_no")).alias("turn_no"), "role").agg(F.array_join(F.transform(pieces, lambda x: x["text"]), "\n").alias("text"))
        turns = turns.where("NOT spans").select("conv", "turn_no", "role", "text").unionByName(whole.select("conv", "turn_no", "role", "text"))
    rendered = F.concat(F.lit("<|"), "role", F.lit("|>\n"), "text", F.lit("<|end|>"))
    return turns.select("conv", "turn_no", "role", "text", rendered.alias("rendered"))
