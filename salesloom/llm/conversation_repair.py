"""Least repairs of conversations: a grammar over all of them, one min-plus matrix with audits per rule."""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesloom.llm.common import small_batches, spread_out, table, written

SPACES = " \t\n\x0b\f\r"
ENDS = ".!?"
LEGAL = ("su", "ua", "au")  # initials of neighbours
DELETE, REROLE, INSERT, TRUNCATED = 4, 3, 3, 3  # costs; keeping a row is free
# States: nothing yet, after a system row, after a user row, after an assistant row.
STATES, ACCEPTED = 4, (0, 3)
SYMBOLS = "DsuaoSUAO"  # must go; kept initials (o: any other); the same, truncated
SPAN = 4096  # rows of a segment, and of what a rule stands for
RULES = 192
PER_ROUND = 32  # rules that are made of one count of pairs
COMBINED = 64  # segments whose matrices are multiplied together
FIRST_RULE = 0x100  # rules are characters from here on


class Rope:
    """An audit: letters, or two audits one after the other, joined when they are first read."""

    __slots__ = ("parts", "_text")

    def __init__(self, *parts: Rope, text: str | None = None):
        self.parts, self._text = parts, text

    @property
    def text(self) -> str:
        if self._text is None:
            out, todo = [], [self]
            while todo:
                rope = todo.pop()
                if rope._text is None:
                    todo += reversed(rope.parts)
                else:
                    out.append(rope._text)
            self._text, self.parts = "".join(out), ()
        return self._text


Entry = tuple[int, Rope] | None
Matrix = list[list[Entry]]


def least(a: Entry, b: Entry) -> Entry:
    """The cheaper one, at equal cost the one whose letters come first in ASCII."""
    if a is None or (b is not None and (b[0] < a[0] or (b[0] == a[0] and b[1].text < a[1].text))):
        return b
    return a


def product(a: Matrix, b: Matrix) -> Matrix:
    """First the rows of ``a``, then those of ``b``.

    The least letters of the whole are made of the least letters of the parts: of two equally dear
    audits of the same rows between the same states none begins with the other, as more letters
    after the same ones would be inserts, which cost.
    """
    out: Matrix = []
    for row in a:
        new: list[Entry] = [None] * STATES
        for mid in range(STATES):
            if row[mid] is None:
                continue
            cost, audit = row[mid]
            for to, entry in enumerate(b[mid]):
                if entry is not None and (new[to] is None or cost + entry[0] <= new[to][0]):
                    new[to] = least(new[to], (cost + entry[0], Rope(audit, entry[1])))
        out.append(new)
    return out


def _next(state: int, initial: str) -> int | None:
    """The state after a row of that initial, if it may follow."""
    if initial == "s":
        return 1 if state == 0 else None
    if initial == "u":
        return 2 if state != 2 else None
    return 3 if initial == "a" and state == 2 else None


def inserted() -> Matrix:
    """Inserted rows only. More than two lead to a state that fewer reach."""
    out: Matrix = []
    for state in range(STATES):
        row: list[Entry] = [None] * STATES
        at = state
        for n in range(3):
            if row[at] is None:
                row[at] = (INSERT * n, Rope(text="I" * n))
            at = 3 if at == 2 else 2
        out.append(row)
    return out


def symbol_matrix(symbol: str) -> Matrix:
    """Inserts before one row, then what may be done to it."""
    edit: Matrix = []
    extra = TRUNCATED if symbol in "SUAO" else 0
    for state in range(STATES):
        row: list[Entry] = [None] * STATES
        row[state] = (DELETE, Rope(text="D"))
        if symbol != "D":
            for initial, cost, letter in ((symbol.lower(), 0, "K"), ("u", REROLE, "R"), ("a", REROLE, "R")):
                to = _next(state, initial)
                if to is not None:
                    row[to] = least(row[to], (cost + extra, Rope(text=letter)))
        edit.append(row)
    return product(inserted(), edit)


def rule_matrices(rules: Sequence[str]) -> dict[str, Matrix]:
    """A matrix per symbol and per rule, each rule's from those of its two parts."""
    out = {s: symbol_matrix(s) for s in SYMBOLS}
    for k, pair in enumerate(rules):
        out[chr(FIRST_RULE + k)] = product(out[pair[0]], out[pair[1]])
    return out


def compressed(text: str, rules: Sequence[str]) -> str:
    """Each rule's pairs replaced from the left, in the order in which rules were made."""
    for k, pair in enumerate(rules):
        text = text.replace(pair, chr(FIRST_RULE + k))
    return text


def pair_counts(text: str) -> Counter:
    """Neighbouring symbols, lines apart; two equal ones count where they don't overlap."""
    codes = np.frombuffer(text.encode("utf-32-le"), dtype="<u4").astype(np.int64)
    a, b = codes[:-1], codes[1:]
    apart = (a != 10) & (b != 10) & (a != b)
    values, counts = np.unique(a[apart] << 32 | b[apart], return_counts=True)
    out = Counter({chr(v >> 32) + chr(v & 0xFFFFFFFF): int(n) for v, n in zip(values.tolist(), counts.tolist())})
    for c in set(text) - {"\n"}:
        out[c + c] = text.count(c + c)
    return +out


def _counted(batches: Iterator[pa.RecordBatch], rules: list[str]) -> Iterator[pa.RecordBatch]:
    total: Counter = Counter()
    for batch in batches:
        total += pair_counts(compressed("\n".join(batch.column("symbols").to_pylist()), rules))
    columns = list(zip(*total.items())) or [[], []]
    yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64())], ["pair", "n"])


def grammar(shapes: DataFrame, rules: int = RULES, span: int = SPAN) -> list[str]:
    """Re-Pair over all ``shapes`` (column symbols): the pairs that occur most often become rules.

    A round counts the pairs of all sequences as the rules so far write them, and makes its
    ``PER_ROUND`` most frequent ones rules, until none occurs twice or there are ``rules``. A bound on
    rules leaves sequences less short, not less whole. At most as many pairs come to the driver a round.
    """
    found: list[str] = []
    length = dict.fromkeys(SYMBOLS, 1)
    while len(found) < rules:
        counts = shapes.select("symbols").mapInArrow(partial(_counted, rules=list(found)), "pair string, n long")
        top = counts.groupBy("pair").agg(F.sum("n").alias("n")).filter("n > 1").orderBy(F.desc("n"), "pair").limit(2 * PER_ROUND)
        new = [r["pair"] for r in top.collect() if length[r["pair"][0]] + length[r["pair"][1]] <= span]
        new = new[: min(PER_ROUND, rules - len(found))]
        if not new:
            break
        for pair in new:
            length[chr(FIRST_RULE + len(found))] = length[pair[0]] + length[pair[1]]
            found.append(pair)
    return found


def sequence_matrix(symbols: str, rules: Sequence[str], matrices: dict[str, Matrix]) -> Matrix:
    out: Matrix | None = None
    for c in compressed(symbols, rules):
        out = matrices[c] if out is None else product(out, matrices[c])
    return out


def cheapest(matrix: Matrix) -> tuple[int, str]:
    """Cost and letters of the least repair of rows with that matrix; rows inserted after the last one count."""
    best: Entry = None
    for state, entry in enumerate(product(matrix[:1], inserted())[0]):
        if state in ACCEPTED:
            best = least(best, entry)
    return best[0], best[1].text


def flat(matrix: Matrix) -> list[dict | None]:
    return [None if e is None else {"cost": e[0], "audit": e[1].text} for row in matrix for e in row]


def unflat(entries) -> Matrix:
    cells = [None if e is None else (int(e["cost"]), Rope(text=e["audit"])) for e in entries]
    return [cells[k : k + STATES] for k in range(0, STATES * STATES, STATES)]


CELL = "array<struct<cost:long,audit:string>>"
_CELL = pa.list_(pa.struct([("cost", pa.int64()), ("audit", pa.string())]))


def _evaluated(batches: Iterator[pa.RecordBatch], rules: list[str]) -> Iterator[pa.RecordBatch]:
    # At most RULES matrices, made once a task.
    matrices = rule_matrices(rules)
    for batch in batches:
        costs, audits, cells = [], [], []
        for symbols, several in zip(batch.column("symbols").to_pylist(), batch.column("several").to_pylist()):
            matrix = sequence_matrix(symbols, rules, matrices)
            cost, audit = cheapest(matrix)
            costs.append(cost), audits.append(audit), cells.append(flat(matrix) if several else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("symbols"), pa.array(costs, pa.int64()), pa.array(audits, pa.string()), pa.array(cells, _CELL)],
            ["symbols", "cost", "audit", "matrix"],
        )


@dataclass
class Stretch:
    """What is counted over consecutive rows of a conversation; two stretches add up."""

    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    first_role: str | None = None
    last_role: str | None = None
    first_turn: int | None = None
    last_turn: int | None = None
    turns: int = 0

    def __add__(self, other: Stretch) -> Stretch:
        if self.first_role is None or other.first_role is None:
            return other if self.first_role is None else self
        same = self.last_turn is not None and self.last_turn == other.first_turn
        return Stretch(
            self.blank + other.blank,
            self.duplicate + other.duplicate,
            self.truncated + other.truncated,
            self.illegal + other.illegal + (self.last_role + other.first_role not in LEGAL),
            self.first_role,
            other.last_role,
            other.first_turn if self.first_turn is None else self.first_turn,
            self.last_turn if other.last_turn is None else other.last_turn,
            self.turns + other.turns - same,
        )


COUNTS = (
    "blank long, duplicate long, truncated long, illegal long, first_role string, last_role string, "
    "first_turn long, last_turn long, turns long"
)
COUNT_NAMES = [c.split()[0] for c in COUNTS.split(", ")]
_COUNT_TYPES = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()] * 3


def _segments(batches: Iterator[pa.RecordBatch], span: int) -> Iterator[pa.RecordBatch]:
    """Rows of one range, sorted: per conversation its symbols, cut every ``span`` rows, and what is counted over them."""
    part, out = TaskContext.get().partitionId(), []
    group, symbols, room, counts, nth = None, [], span, Stretch(), 0

    def close():
        nonlocal symbols, room, counts, nth
        if symbols:
            out.append((group, part, nth, "".join(symbols), *[getattr(counts, c) for c in COUNT_NAMES]))
            symbols, room, counts, nth = [], span, Stretch(), nth + 1

    def ready():
        columns = list(zip(*out)) or [[]] * (4 + len(COUNT_NAMES))
        kinds = [pa.string(), pa.int32(), pa.int64(), pa.string(), *_COUNT_TYPES]
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["grp", "part", "nth", "symbols", *COUNT_NAMES])

    for batch in batches:
        for g, turn, initial, fault, n in zip(*[batch.column(c).to_pylist() for c in ("grp", "turn", "initial", "fault", "n")]):
            if g != group:
                close()
                group, nth = g, 0
            kind = initial if initial in ("s", "u", "a") else "o"
            symbol = {"blank": "D", "duplicate": "D", "truncated": kind.upper()}.get(fault, kind)
            again = "blank" if fault == "blank" else "duplicate"
            while n:
                # The first copy, then the others, as many as there is room for.
                take = 1 if symbol != "D" else min(n, room)
                own = Stretch(first_role=initial, last_role=initial, first_turn=turn, last_turn=turn, turns=int(turn is not None))
                own.illegal = take - 1
                if fault is not None:
                    setattr(own, fault, take)
                counts = counts + own
                symbols.append(symbol * take)
                n, room, symbol, fault = n - take, room - take, "D", again
                if not room:
                    close()
        if len(out) >= 1024:
            yield ready()
    close()
    yield ready()


def _combined(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("seq", kind="stable")
    matrix, counts = None, Stretch()
    for r in rows.to_dict("records"):
        own = unflat(r["matrix"])
        matrix = own if matrix is None else product(matrix, own)
        values = [None if r[c] is None or r[c] != r[c] else r[c] for c in COUNT_NAMES]
        counts = counts + Stretch(*[int(v) if isinstance(v, float) else v for v in values])
    cost, audit = cheapest(matrix)
    found = [rows["grp"].iloc[0], int(rows["seq"].iloc[0]) // COMBINED, flat(matrix), cost, audit, *[getattr(counts, c) for c in COUNT_NAMES]]
    return pd.DataFrame([found], columns=["grp", "seq", "matrix", "cost", "audit", *COUNT_NAMES])


def marked(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows in the form that ``repair`` reads: grp (the conversation, null told apart), turn, role, text (null: one space), copies, ``mark`` of the text, blank, truncated."""
    own = rows.select(
        F.coalesce(F.concat(F.lit("1"), F.col(conv).cast("string")), F.lit("0")).alias("grp"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"),
        (F.col("copies") if "copies" in rows.columns else F.lit(1)).cast("long").alias("copies"),
    )
    said = F.rtrim(F.col("text"), F.lit(SPACES))
    return own.withColumns({"mark": F.md5("text"), "blank": said == "", "truncated": ~F.right(said, F.lit(1)).isin(*ENDS)})


def _order() -> list[Column]:
    return [F.col("grp"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("mark")]


@dataclass
class Repairs:
    """``reports``: grp, blank, duplicate, truncated, illegal, gaps, cost, audit, of conversations with rows; ``rows`` as given."""

    reports: DataFrame
    rows: DataFrame

    def _in_order(self, edit: Callable, schema: str) -> DataFrame:
        """Every conversation's audit, then its rows in order, through ``edit``."""
        kinds = "grp string, turn long, role string, mark string, text string, copies long, audit string"
        names = [c.split()[0] for c in kinds.split(", ")]
        audits = self.reports.select("grp", "audit")
        both = self.rows.select(*names[:-1]).unionByName(audits, allowMissingColumns=True)
        order = [F.col("grp"), F.col("audit").isNull(), *_order()[1:]]
        return both.repartition("grp").sortWithinPartitions(*order).mapInArrow(edit, schema)

    def repaired(self) -> DataFrame:
        """The repaired conversations: grp, nth (from 0), role, text, edit (K, R or I)."""
        return self._in_order(_repaired_rows, "grp string, nth long, role string, text string, edit string")

    def digests(self) -> DataFrame:
        """grp and the SHA-256 of its repaired rows, ``role:text``, joined by newlines; rows stream through, one conversation is one pass."""
        return self._in_order(_repaired_hash, "grp string, repaired_sha256 string")


ROLES = {2: "user", 3: "assistant"}


def edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str | None, str | None, str | None]]:
    """(grp, role, text, edit) of every row that stays, and (grp, None, None, None) after a conversation's last."""
    group, audit, at, state = None, "", 0, 0

    def inserts():
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            state, at = (3 if state == 2 else 2), at + 1
            yield group, ROLES[state], "", "I"

    for batch in batches:
        for g, role, text, copies, letters in zip(*[batch.column(c).to_pylist() for c in ("grp", "role", "text", "copies", "audit")]):
            if letters is not None:
                if group is not None:
                    yield from inserts()
                    yield group, None, None, None
                group, audit, at, state = g, letters, 0, 0
                continue
            for _ in range(copies):
                yield from inserts()
                edit = audit[at]
                at += 1
                if edit == "D":
                    continue
                if edit == "K":
                    state = _next(state, role[:1])
                else:
                    state = 3 if state == 2 else 2
                yield group, role if edit == "K" else ROLES[state], text, edit
    if group is not None:
        yield from inserts()
        yield group, None, None, None


def _repaired_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def ready():
        columns = list(zip(*rows)) or [[]] * 5
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()])],
            ["grp", "nth", "role", "text", "edit"],
        )

    rows, nth = [], 0
    for group, role, text, edit in edited(batches):
        if edit is None:
            nth = 0
            continue
        rows.append((group, nth, role, text, edit))
        nth += 1
        if len(rows) == 256:
            yield ready()
            rows = []
    yield ready()


def _repaired_hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def ready():
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in (groups, hashes)], ["grp", "repaired_sha256"])

    groups, hashes, total, between = [], [], hashlib.sha256(), ""
    for group, role, text, edit in edited(batches):
        if edit is not None:
            total.update(f"{between}{role}:{text}".encode())
            between = "\n"
            continue
        groups.append(group), hashes.append(total.hexdigest())
        total, between = hashlib.sha256(), ""
        if len(groups) == 4096:
            yield ready()
            groups, hashes = [], []
    yield ready()


def repair(rows: DataFrame, rules: int = RULES, span: int = SPAN) -> Repairs:
    """The least repair of every conversation of ``rows`` (see ``marked``).

    Rows of a conversation stand by turn (null first), then role and mark of the text; a row counts
    ``copies`` times, the copies next to each other. The first fault of a row counts: ``blank``,
    ``duplicate`` (role and text stood before), ``truncated`` (does not end in ``ENDS``). Edits: keep, rerole to user
    or assistant (3), delete (4, and required for blank and duplicate rows), insert an empty user or
    assistant row (3); a truncated row that stays costs 3 more. The initials of the roles must then
    read ``(s?(ua)+)?``. The cheapest audit, at equal cost the least in ASCII, is found by
    multiplying min-plus matrices over the states of that pattern: one per rule of a grammar of all
    conversations' symbols, made bottom-up and used by all of them. Conversations of any length are cut into segments
    of ``span`` rows, whose matrices are multiplied in groups. A conversation without rows has no report.
    """
    spark = rows.sparkSession
    spread_out(spark)
    small_batches(spark)
    key = ["grp", "turn", "role", "mark"]
    turns = written(rows.groupBy(*key).agg(F.sum("copies").alias("n"), F.first("blank").alias("blank"), F.first("truncated").alias("truncated")), "turns")
    # A text that some role has on several turns: its first turn is no duplicate.
    place = F.struct(F.col("turn").isNotNull().alias("has"), F.col("turn"))
    firsts = turns.filter("NOT blank").groupBy("grp", "role", "mark").agg(F.min(place).alias("lead"), F.max(place).alias("final"))
    firsts = written(firsts.filter("lead <> final").drop("final"), "first-turns")
    fault = (
        F.when(F.col("blank"), "blank").when(F.col("lead").isNotNull() & (place != F.col("lead")), "duplicate").when(F.col("truncated"), "truncated")
    )
    known = turns.join(firsts, ["grp", "role", "mark"], "left")
    known = known.select(*key, "n", F.left("role", F.lit(1)).alias("initial"), fault.alias("fault"))
    ranged = known.repartitionByRange(*_order()).sortWithinPartitions(*_order())
    schema = f"grp string, part int, nth long, symbols string, {COUNTS}"
    segments = written(ranged.mapInArrow(partial(_segments, span=span), schema), "segments")
    long_ = segments.groupBy("grp").agg(F.count("*").alias("c")).filter("c > 1").select("grp", F.lit(True).alias("several"))
    segments = written(segments.join(long_, "grp", "left").withColumn("several", F.coalesce("several", F.lit(False))), "conversation-segments")
    shapes = written(segments.groupBy("symbols").agg(F.max("several").alias("several")), "shapes")
    found = shapes.mapInArrow(partial(_evaluated, rules=grammar(shapes, rules, span)), f"symbols string, cost long, audit string, matrix {CELL}")
    found = written(found, "shape-matrices")
    whole = segments.filter("NOT several").join(found.drop("matrix"), "symbols")
    parts = segments.filter("several").join(found.select("symbols", "matrix"), "symbols")
    names = ["grp", "cost", "audit", *COUNT_NAMES]
    reports = whole.select(*names)
    # One row per SPAN rows of long conversations.
    own = Window.partitionBy("grp").orderBy("part", "nth")
    parts = parts.withColumn("seq", F.row_number().over(own).cast("long") - 1).select("grp", "seq", "matrix", *COUNT_NAMES)
    schema = f"grp string, seq long, matrix {CELL}, cost long, audit string, {COUNTS}"
    while not parts.isEmpty():
        made = written(parts.groupBy("grp", F.expr(f"seq div {COMBINED}").alias("of")).applyInPandas(_combined, schema), "combined")
        last = made.groupBy("grp").agg(F.max("seq").alias("last"))
        done = made.join(last, "grp")
        reports = reports.unionByName(done.filter("last = 0").select(*names))
        parts = done.filter("last > 0").select("grp", "seq", "matrix", *COUNT_NAMES)
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns"), F.lit(0).cast("long"))
    reports = reports.select("grp", "blank", "duplicate", "truncated", "illegal", gaps.alias("gaps"), "cost", "audit")
    return Repairs(written(reports, "repairs"), rows)


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations damaged by the CRC-32 of ``conv_id:turn``, modulo 20 (nulls of any column read as one space).

    0 drops the row, 1 empties its text, 2 removes ``ENDS`` from it, 3 repeats it (``copies`` 2), 4 makes its role user.
    """
    said = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    own = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), (F.crc32(F.concat_ws(":", *said)) % 20).alias("hit"))
    text = F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    return own.filter("hit <> 0").select(
        "conv_id", "turn", F.when(F.col("hit") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.when(F.col("hit") == 3, 2).otherwise(1).alias("copies")
    )


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    made = repair(marked(damaged(rows)))
    found = made.reports.join(made.digests(), "grp")
    every = rows.select("conv_id", F.coalesce(F.concat(F.lit("1"), F.col("conv_id").cast("string")), F.lit("0")).alias("of")).distinct()
    zero = F.lit(0).cast("long")
    return every.join(found, F.col("of") == F.col("grp"), "left").select(
        "conv_id",
        *[F.coalesce(c, zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
