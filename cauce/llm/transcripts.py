"""Chat formatting: roles of a raw transcript by a hidden Markov model.

A transcript is lines of text. The hidden state of a line is its speaker's role
and whether it opens a turn or continues one; what is seen of it are its
speaker marker (if any), whether a blank line stands before it, its length and
how it ends. Start, transition and emission probabilities are smoothed counts
over all transcripts whose roles are known; Viterbi recovers the most likely
roles, and turns are rendered in one canonical form.

Long conversations are worked off in pieces of ``PIECE`` turn numbers. Where turn numbers
are null or repeat, so that such a block holds more than twice as many rows, it is cut by
running row counts instead: first between turns, then, inside a turn of many rows, by ranges
of the text's hash, and rows that agree in every column are counted and cut by their count.
So a piece holds a few times ``PIECE`` rows at most, whatever repeats. A piece gives the
best score from every state before it to every state at its end, a small matrix; the matrices
are multiplied over runs of ``RUN`` pieces, the runs of a conversation are chained to find the
states between runs, each run is chained between its two known ends, and so is each piece.
A turn that goes on over a border stays open there: the pieces' chats, joined, are the one
chat of a single Viterbi pass, but no task holds more than a piece's text.

Defined results: null text is an empty turn; an unknown or null role is not
learned from; rows that repeat a turn number follow each other by their text's
hash; a null conversation id is a conversation; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cauce.llm.common import ship, stage

ROLES = ["system", "user", "assistant"]
STATES = 2 * len(ROLES)  # 2 * role opens a turn, 2 * role + 1 continues it
PIECE = 1024
#: Pieces of a conversation that are chained together.
RUN = 512
#: Crowded blocks are broadcast up to this many, else joined.
MAX_BROADCAST_BLOCKS = 200_000

#: Speaker names by role, as transcripts write them.
NAMES = {
    "system": ["system", "instruction", "instructions", "context"],
    "user": ["user", "human", "question", "q", "customer", "me", "prompt"],
    "assistant": ["assistant", "ai", "bot", "answer", "a", "agent", "model", "response"],
}
_ROLE_OF = {name: i for i, role in enumerate(ROLES) for name in NAMES[role]}
MARKER = re.compile(r"^\s*(?:\*\*|#{1,4}\s*|<\|?|\[)?(" + "|".join(sorted(_ROLE_OF, key=len, reverse=True))
                    + r")(?:\*\*|\|?>|\])?\s*(?::(?:\*\*)?|(?<=[>\]]))\s?", re.IGNORECASE)

#: Features of a line and their numbers of values.
SIZES = [len(ROLES) + 1, 2, 8, 4]


def observe(lines: list[str]) -> tuple[list[tuple[int, ...]], list[str]]:
    """(features, text without marker) of every line that isn't blank."""
    seen, rest, blank = [], [], 0
    for line in lines:
        if not line.strip():
            blank = 1
            continue
        m = MARKER.match(line)
        body = line[m.end():] if m else line
        end = body.rstrip()[-1:]
        ending = 1 if end == "?" else 2 if end in (".", "!") and end else 3 if end == ":" else 0
        seen.append((_ROLE_OF[m.group(1).lower()] + 1 if m else 0, blank,
                     min(7, len(body).bit_length() // 2), ending))
        rest.append(body)
        blank = 0
    return seen, rest


class Model:
    """Log probabilities from counts: start, step, and one table a feature."""

    def __init__(self, start: np.ndarray, step: np.ndarray, emit: list[np.ndarray]):
        allowed = np.zeros((STATES, STATES), bool)
        for r in range(len(ROLES)):
            allowed[:, 2 * r] = True  # any turn may open
            allowed[2 * r:2 * r + 2, 2 * r + 1] = True  # only its own may continue
        opens = np.arange(STATES) % 2 == 0
        with np.errstate(divide="ignore"):
            self.start = np.log(np.where(opens, start + 0.5, 0) / (start[opens] + 0.5).sum())
            self.step = np.log(np.where(allowed, step + 0.5, 0)
                               / np.where(allowed, step + 0.5, 0).sum(1, keepdims=True))
        self.emit = [np.log((e + 0.5) / (e + 0.5).sum(1, keepdims=True)) for e in emit]

    def scores(self, seen) -> np.ndarray:
        """Emission score of every line and state."""
        if not len(seen):
            return np.zeros((0, STATES))
        f = np.asarray(seen)
        return sum(self.emit[i][:, f[:, i]].T for i in range(len(SIZES)))

    def span(self, seen) -> np.ndarray:
        """Best score from each state before the lines (the last row: none, the
        conversation starts here) to each state at their end."""
        best = np.full((STATES + 1, STATES), -np.inf)
        for t, e in enumerate(self.scores(seen)):
            if t:
                best = (best[:, :, None] + self.step[None]).max(1) + e
            else:
                best[:STATES], best[STATES] = self.step + e, self.start + e
        return best

    def viterbi(self, seen, before: int, after: int) -> list[int]:
        """Best states between a given state before (STATES: none) and a given last one."""
        e = self.scores(seen)
        if not len(e):
            return []
        best = (self.start if before == STATES else self.step[before]) + e[0]
        back = []
        for row in e[1:]:
            via = best[:, None] + self.step
            back.append(via.argmax(0))
            best = via.max(0) + row
        states = [after]
        for b in reversed(back):
            states.append(int(b[states[-1]]))
        return states[::-1]


def product(spans: list[np.ndarray | None]) -> np.ndarray | None:
    """The matrix of pieces that follow each other (None: none has lines)."""
    whole = None
    for m in spans:
        if m is not None:
            whole = m if whole is None else (whole[:, :, None] + m[None, :STATES]).max(1)
    return whole


def chain(spans: list[np.ndarray | None], before: int = STATES, after: int | None = None) -> list[tuple[int, int]]:
    """(state before, state at the end) of each piece on the best path from a
    given state (STATES: nothing spoken yet) to a given one (None: the best).
    A piece without lines is None and passes its state on."""
    best, back = np.full(STATES + 1, -np.inf), []
    best[before] = 0.0
    for m in spans:
        if m is None:
            back.append(np.arange(STATES + 1))
            continue
        via = best[:, None] + m
        back.append(np.append(via.argmax(0), STATES))
        best = np.append(via.max(0), -np.inf)
    at, out = int(best.argmax()) if after is None else after, []
    for b in reversed(back):
        out.append((int(b[at]), at))
        at = int(b[at])
    return out[::-1]


def render(states: list[int], rest: list[str], before: int = STATES, last: bool = True) -> tuple[str, str]:
    """(roles of the turns that open here, canonical form): a role line, the
    text, an end line per turn. A piece after the first (``before``: the state
    that the one before ends in) first ends the open turn or carries it on; only
    the last piece ends its own last turn."""
    roles, out, spoken = "", [], before != STATES
    for s, text in zip(states, rest):
        if s % 2 == 0 or not spoken:
            role = ROLES[s // 2]
            out.append("<|end|>\n" if spoken else "")
            out.append(f"<|{role}|>\n")
            roles, spoken = roles + role[0], True
        out.append(text + "\n")
    if spoken and last:
        out.append("<|end|>\n")
    return roles, "".join(out)


#: How raw transcripts mark a speaker: every style's text before a turn.
STYLES = [{"system": "System: ", "user": "User: ", "assistant": "Assistant: "},
          {"system": "### Instruction: ", "user": "### Human: ", "assistant": "### Assistant: "},
          {"system": "Context: ", "user": "Q: ", "assistant": "A: "},
          {"system": "**System:** ", "user": "**Customer:** ", "assistant": "**Agent:** "}]


def write_transcript(conv_id, rows: list[dict]) -> tuple[list[str], list[int], list[str]]:
    """A conversation's turns as raw lines: one style a conversation, and every
    fourth turn or so without its marker, after a blank line. With the lines
    come the states that wrote them (-1: role unknown) and the role per turn."""
    pick = int(hashlib.md5(str(conv_id).encode()).hexdigest(), 16)
    style, lines, states, roles = STYLES[pick % len(STYLES)], [], [], []
    for row in rows:
        role, text = row["role"], (row["text"] or "")
        known = ROLES.index(role) if role in ROLES else -1
        bare = known < 0 or (pick >> 8) + (row["turn"] or 0) * 7 & 3 == 3
        body = [x for x in text.split("\n") if x.strip()] or ["-"]
        lines += ([""] if bare else []) + [("" if bare else style[role]) + body[0], *body[1:]]
        states += [2 * known if known >= 0 else -1] + [2 * known + 1 if known >= 0 else -1] * (len(body) - 1)
        roles.append(role)
    return lines, states, roles


_PIECES = ("conv_id long, piece int, lines array<string>, states array<int>, roles array<string>")


def listed(copies: Column) -> Column:
    return F.sort_array(F.collect_list(F.struct("turn", "tie", "role", "text", copies.cast("int").alias("copies")))).alias("rows")


def numbered(rows: DataFrame, crowded: DataFrame) -> DataFrame:
    """conv_id, piece, rows: blocks as they are, but those listed in ``crowded``
    (c, b) cut by running row counts. A piece is known by its block and, in a
    crowded one, by slot, heavy turn, range of ties and single row; pieces are
    numbered over a table with one narrow row per piece."""
    here = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b"))
    cut = ["block", "slot", "heavy", "part", "one_tie", "one_role", "batch"]
    none = F.lit(None)
    calm = (rows.join(crowded, here, "left_anti")
            .withColumns({"slot": F.lit(0).cast("long"), "heavy": F.lit(0).cast("long"), "part": F.lit(0).cast("long"),
                          "one_tie": none.cast("long"), "one_role": none.cast("string"), "batch": F.lit(0).cast("long")})
            .groupBy("conv_id", *cut).agg(listed(F.lit(1))))
    # rows that agree are one row with a count, in batches of PIECE copies at most
    units = (rows.join(crowded, here, "left_semi").groupBy("conv_id", "block", "turn", "tie", "role", "text")
             .agg(F.count(F.lit(1)).alias("m"))
             .withColumn("many", F.explode(F.expr(f"sequence(0L, (m - 1) div {PIECE})")))
             .withColumn("copies", F.least(F.lit(PIECE), F.col("m") - F.col("many") * PIECE)))
    units = stage(units.drop("m"))
    # a block has no more turns than PIECE and null: its window is small
    turns = units.groupBy("conv_id", "block", "turn").agg(F.sum("copies").alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv_id", "block").orderBy(F.col("turn").asc_nulls_first())) - F.col("n")
    turns = turns.withColumn("slot", F.floor(before / PIECE)).withColumn("heavy", (F.col("n") > PIECE).cast("long"))
    turns = turns.select(F.col("conv_id").alias("c"), F.col("block").alias("b"), F.col("turn").alias("t"), "slot",
                         "heavy", F.when(F.col("n") > PIECE, F.ceil(F.col("n") / PIECE)).otherwise(1).alias("parts"))
    units = units.join(turns, here & F.col("turn").eqNullSafe(F.col("t"))).drop("c", "b", "t")
    at = F.floor((F.col("tie").cast("double") / float(1 << 64) + 0.5) * F.col("parts"))
    units = units.withColumn("part", F.least(at, F.col("parts") - 1).cast("long"))
    # a range that is still too full holds rows with many copies: each row is a piece
    full = (units.groupBy(F.col("conv_id").alias("c"), F.col("block").alias("b"), F.col("slot").alias("s"),
                          F.col("heavy").alias("v"), F.col("part").alias("p"))
            .agg((F.sum("copies") > 4 * PIECE).alias("full")))
    same = here & (F.col("slot") == F.col("s")) & (F.col("heavy") == F.col("v")) & (F.col("part") == F.col("p"))
    units = units.join(full, same).withColumn("one_tie", F.when(F.col("full"), F.col("tie"))) \
        .withColumn("one_role", F.when(F.col("full"), F.col("role"))) \
        .withColumn("batch", F.when(F.col("full"), F.col("many")).otherwise(0).cast("long"))
    pieces = stage(calm.unionByName(units.groupBy("conv_id", *cut).agg(listed(F.col("copies")))))
    order = [F.col(x).asc_nulls_first() for x in cut]
    numbers = pieces.select("conv_id", *cut).withColumn(
        "piece", F.row_number().over(Window.partitionBy("conv_id").orderBy(*order)) - 1)
    names = {x: f"n_{x}" for x in ["conv_id", *cut]}
    numbers = numbers.withColumnsRenamed(names)
    on = F.lit(True)
    for x, y in names.items():
        on = on & F.col(x).eqNullSafe(F.col(y))
    return pieces.join(numbers, on).select("conv_id", "piece", "rows")


def transcripts(conversations: DataFrame) -> DataFrame:
    """Raw transcripts written from a table of conv_id, turn, role, text."""
    ship(conversations.sparkSession)
    rows = conversations.select("conv_id", "turn", "role", "text", F.xxhash64("text").alias("tie"))
    rows = rows.withColumn("block", F.coalesce(F.floor(F.col("turn") / PIECE), F.lit(0)).cast("long"))
    crowded = stage(rows.groupBy(F.col("conv_id").alias("c"), F.col("block").alias("b"))
                    .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 2 * PIECE).select("c", "b"))
    n_crowded = crowded.count()
    if n_crowded:
        grouped = numbered(rows, F.broadcast(crowded) if n_crowded <= MAX_BROADCAST_BLOCKS else crowded)
    else:  # every block is a piece
        grouped = rows.groupBy("conv_id", F.col("block").cast("int").alias("piece")).agg(listed(F.lit(1)))

    def task(batches):
        for b in batches:
            made = [write_transcript(c, [r for r in rows for _ in range(r["copies"])])
                    for c, rows in zip(b.column(0).to_pylist(), b.column(2).to_pylist())]
            cols = [[m[i] for m in made] for i in range(3)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).cast(pa.int64()), b.column(1), pa.array(cols[0], pa.list_(pa.string())),
                 pa.array(cols[1], pa.list_(pa.int32())), pa.array(cols[2], pa.list_(pa.string()))],
                ["conv_id", "piece", "lines", "states", "roles"])

    return grouped.mapInArrow(task, _PIECES)


def fit(pieces: DataFrame) -> Model:
    """Counts over all pieces whose lines' states are known, summed by Spark."""
    size = STATES + STATES * STATES + STATES * sum(SIZES)

    def task(batches):
        start, step = np.zeros(STATES), np.zeros((STATES, STATES))
        emit = [np.zeros((STATES, n)) for n in SIZES]
        for b in batches:
            for piece, lines, states in zip(*(c.to_pylist() for c in b.columns)):
                seen, _ = observe(lines)
                if len(seen) != len(states) or not states:
                    continue
                s = np.asarray(states)
                f = np.asarray(seen)
                if s[0] >= 0 and not piece:
                    start[s[0]] += 1
                both = (s[:-1] >= 0) & (s[1:] >= 0)
                np.add.at(step, (s[:-1][both], s[1:][both]), 1)
                for i, e in enumerate(emit):
                    np.add.at(e, (s[s >= 0], f[s >= 0, i]), 1)
        total = np.concatenate([start, step.ravel(), *[e.ravel() for e in emit]])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], ["i", "v"])

    got = pieces.select("piece", "lines", "states").mapInArrow(task, "i long, v double")
    total = np.zeros(size)
    for i, v in got.groupBy("i").agg(F.sum("v").alias("v")).collect():  # one row per count of the model
        total[i] = v
    start, total = total[:STATES], total[STATES:]
    step, total = total[:STATES * STATES].reshape(STATES, STATES), total[STATES * STATES:]
    emit = []
    for n in SIZES:
        emit.append(total[:STATES * n].reshape(STATES, n))
        total = total[STATES * n:]
    return Model(start, step, emit)


#: Types of (conversation, number, state before, state at the end, last one).
ENDS = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_()]


def parse(pieces: DataFrame, model: Model) -> DataFrame:
    """Roles recovered from ``lines`` alone: conv_id, piece, n_lines, n_turns
    (opened in the piece), roles (their first letters), chat (canonical form)."""
    ship(pieces.sparkSession)

    def spans(batches):
        for b in batches:
            out = []
            for lines in b.column(2).to_pylist():
                seen, _ = observe(lines)
                out.append(model.span(seen).ravel().tolist() if seen else None)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.list_(pa.float64()))],
                                             ["conv_id", "piece", "span"])

    small = pieces.select("conv_id", "piece", "lines").mapInArrow(spans, "conv_id long, piece int, span array<double>")
    runs = stage(small.groupBy("conv_id", F.floor(F.col("piece") / RUN).alias("run"))
                 .agg(F.sort_array(F.collect_list(F.struct("piece", "span"))).alias("all")))

    def matrix(span):
        return None if span is None else np.array(span).reshape(STATES + 1, STATES)

    def multiply(batches):
        for b in batches:
            out = [product([matrix(p["span"]) for p in every]) for every in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([None if m is None else m.ravel().tolist() for m in out],
                                                    pa.list_(pa.float64()))], ["conv_id", "run", "span"])

    whole = runs.select("conv_id", "run", "all").mapInArrow(multiply, "conv_id long, run long, span array<double>") \
        .groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("run", "span"))).alias("all"))

    def between(batches):
        for b in batches:
            cols: list[list] = [[], [], [], [], []]
            for conv, every in zip(*(c.to_pylist() for c in b.columns)):
                for r, (x, y) in zip(every, chain([matrix(r["span"]) for r in every])):
                    for col, v in zip(cols, (conv, r["run"], x, y, r["run"] == every[-1]["run"])):
                        col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, ENDS)],
                                             ["conv", "r", "x", "y", "final"])

    known = whole.mapInArrow(between, "conv long, r long, x int, y int, final boolean")
    inside = runs.join(known, F.col("conv_id").eqNullSafe(F.col("conv")) & (F.col("run") == F.col("r")))

    def ends(batches):
        for b in batches:
            cols: list[list] = [[], [], [], [], []]
            for conv, every, x, y, final in zip(*(c.to_pylist() for c in b.columns)):
                for p, (s, e) in zip(every, chain([matrix(p["span"]) for p in every], x, y)):
                    last = final and p["piece"] == every[-1]["piece"]
                    for col, v in zip(cols, (conv, p["piece"], s, e, last)):
                        col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, ENDS)],
                                             ["conv", "at", "before", "after", "last"])

    found = inside.select("conv_id", "all", "x", "y", "final").mapInArrow(
        ends, "conv long, at long, before int, after int, last boolean")
    joined = pieces.join(found, F.col("conv_id").eqNullSafe(F.col("conv")) & (F.col("piece") == F.col("at")))

    def decode(batches):
        for b in batches:
            cols: list[list] = [[] for _ in range(6)]
            for conv, piece, lines, before, after, last in zip(*(c.to_pylist() for c in b.columns)):
                seen, rest = observe(lines)
                roles, chat = render(model.viterbi(seen, before, after), rest, before, last)
                row = (conv, piece, len(lines), len(roles), roles, chat)
                for col, v in zip(cols, row):
                    col.append(v)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                             ["conv_id", "piece", "n_lines", "n_turns", "roles", "chat"])

    return joined.select("conv_id", "piece", "lines", "before", "after", "last").mapInArrow(
        decode, "conv_id long, piece int, n_lines long, n_turns long, roles string, chat string")


def format_chats(conversations: DataFrame) -> DataFrame:
    """Write raw transcripts, learn from those not held out (a fifth, by id),
    recover the roles of all and render them."""
    pieces = stage(transcripts(conversations))
    learned = F.coalesce(F.crc32(F.col("conv_id").cast("string").cast("binary")) % 5 != 0, F.lit(False))
    return parse(pieces, fit(pieces.where(learned)))
