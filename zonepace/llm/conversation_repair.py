"""Conversation structure repair by Knuth's lightest derivations.

A conversation is sound when the initials of its roles, in turn order, form
``(s?(ua)+)?``.  Rows are edited at a price: Keep 0, Rerole to user or assistant 1, Delete 2,
Insert an empty user or assistant turn 5, and 5 more for every truncated row that is not
deleted; blank and duplicate rows must be deleted.  The cheapest edits win, of equally
cheap ones the least string of their initials (the audit).

Deductions.  An item [p; j; q] says: the first j segments of a stretch lead from state p to
state q (states: start, s, u, a).  Axioms are [p; 0; p] and the edits of each row,
(r -> q, cost, letters).  Rules:

    [p; j; r] and an edit (r -> q) of segment j   =>  [p; j+1; q]
    [p; j; r] and an insertion (r -> q)           =>  [p; j; q]

A derivation weighs (cost, segments covered, audit), put together by adding and
joining.  Both rules are superior: they add a segment or cost, so a conclusion outweighs its
premises; and joining keeps the order (of two equally dear derivations of one item neither
audit begins the other).  So an agenda that pops the lightest item finds each
item's lightest derivation at its first pop and stops when its goals are final.

The same deductions run on rows, on blocks of ``BLOCK`` rows and on parts of a
conversation: the finished items of a stretch are the edits of one longer segment.  So a
conversation of any length is cut up: its rows are dealt by (conversation, turn) ranges, each
task derives the items of its part, and a part is a row of at most sixteen items.

Then parts and texts meet, sorted by conversation (secondary sort): the parts
give the audit, and the rows stream past it, into a digest or out as repaired
rows.  A SHA-256 is one chain, so this last stream of a conversation is one task's; it
holds the audit and one batch of rows.

Order: by turn, nulls first; rows of one turn by the digest of role and text.  Rows that
agree in conversation, turn, role and text are counted before they are shuffled.
"""

from __future__ import annotations

import hashlib
import heapq

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from zonepace.llm.common import small_batches, written

BLOCK = 256
START, SYSTEM, USER, ASSISTANT = range(4)
STATES, SOUND = (START, SYSTEM, USER, ASSISTANT), (START, ASSISTANT)
# Prices, the white space of a blank text, the legal neighbours of role initials.
RENAME, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
SPACE = " \t\n\x0b\x0c\r"
LEGAL = ("su", "ua", "au")
ROLE = {USER: "user", ASSISTANT: "assistant"}
# The state that a spoken turn leads to, by the state before; a system turn only opens.
SPOKEN = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_COUNTS = ("blank", "duplicate", "truncated", "illegal")


# ---------------------------------------------------------------- deductions

def row_edits(initial: str, forced: bool, truncated: bool, copies: int) -> dict[int, list[tuple[int, int, str]]]:
    """state -> [(next state, cost, letters)] of a row and its ``copies - 1`` repeats; ``forced`` rows go."""
    again = copies - 1
    tail, extra = "D" * again, DELETE * again
    out = {}
    for r in STATES:
        edits = [(r, DELETE + extra, "D" + tail)]
        if not forced:
            late = TRUNCATED if truncated else 0
            to = SPOKEN[r]
            edits.append((to, RENAME + late + extra, "R" + tail))
            if initial == "":  # an empty role adds nothing to the initials
                edits.append((r, late + extra, "K" + tail))
            elif initial == "s" and r == START:
                edits.append((SYSTEM, late + extra, "K" + tail))
            elif initial == ("a" if to == ASSISTANT else "u"):
                edits.append((to, late + extra, "K" + tail))
        out[r] = edits
    return out


def lightest(segments: list[dict], starts=(START,), goals=None) -> dict[tuple[int, int], tuple[int, str]]:
    """(p, q) -> (cost, audit): the lightest derivations of [p; all segments; q].

    With ``goals`` (states) the agenda ends when the first of them is final; else when all items are.
    """
    end, final, found = len(segments), set(), {}
    agenda = [(0, 0, "", p, p) for p in starts]
    while agenda:
        cost, j, audit, p, q = heapq.heappop(agenda)
        if (j, p, q) in final:
            continue
        final.add((j, p, q))
        if j == end:
            found[p, q] = cost, audit
            if goals and q in goals:
                return {(p, q): (cost, audit)}
            if len(found) == len(starts) * len(STATES):
                return found
        else:
            for to, price, letters in segments[j].get(q, ()):
                if (j + 1, p, to) not in final:
                    heapq.heappush(agenda, (cost + price, j + 1, audit + letters, p, to))
        to = SPOKEN[q]
        if (j, p, to) not in final:
            heapq.heappush(agenda, (cost + INSERT, j, audit + "I", p, to))
    return found


def as_segment(items: dict[tuple[int, int], tuple[int, str]]) -> dict[int, list[tuple[int, int, str]]]:
    """The finished items of a stretch as the edits of one segment."""
    out: dict = {}
    for (p, q), (cost, audit) in items.items():
        out.setdefault(p, []).append((q, cost, audit))
    return out


class Part:
    """The rows of one conversation in one partition, in order: counts and lightest items, block by block."""

    def __init__(self, conv, key, opens: bool):
        self.conv, self.key = conv, key
        self.starts = (START,) if opens else STATES
        self.counts = dict.fromkeys(_COUNTS, 0)
        self.first = self.last = self.low = self.high = None
        self.turns, self.block, self.done = 0, [], None

    def add(self, turn, copies, initial, first, blank, truncated):
        forced = blank or not first
        self.counts["blank"] += copies if blank else 0
        self.counts["duplicate"] += 0 if blank else copies - (0 if forced else 1)
        self.counts["truncated"] += int(not forced and truncated)
        self.counts["illegal"] += int(self.last is not None and self.last + initial not in LEGAL) + copies - 1
        self.first, self.last = initial if self.first is None else self.first, initial
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low, self.high = turn if self.low is None else self.low, turn
        if forced:
            letters = {r: [(r, DELETE * copies, "D" * copies)] for r in STATES}
        else:
            letters = row_edits(initial, False, truncated, copies)
        self.block.append(letters)
        if len(self.block) == BLOCK:
            self.fold()

    def fold(self):
        items = lightest(self.block, self.starts if self.done is None else STATES)
        self.done = items if self.done is None else lightest([as_segment(self.done), as_segment(items)], self.starts)
        self.block = []

    def items(self, whole: bool) -> dict:
        """The part's items; of a whole conversation the goal alone."""
        if whole and self.done is None:
            return lightest(self.block, (START,), SOUND)
        if self.block:
            self.fold()
        return self.done


def join_parts(parts: list[dict]) -> dict:
    """Counts, gaps, cost and audit of a conversation from its parts in order."""
    out = dict.fromkeys(_COUNTS, 0)
    last = low = high = None
    turns, items = 0, None
    for part in parts:
        for c in _COUNTS:
            out[c] += part[c]
        out["illegal"] += int(last is not None and last + part["first"] not in LEGAL)
        last = part["last"]
        if part["low"] is not None:
            turns += part["turns"] - (part["low"] == high)
            low, high = part["low"] if low is None else low, part["high"]
        own: dict = {}
        for p, q, cost, audit in zip(part["p"], part["q"], part["cost"], part["audit"]):
            own.setdefault(p, []).append((q, cost, audit))
        items = own if items is None else as_segment(lightest([items, own]))
    out["gaps"] = 0 if low is None else high - low + 1 - turns
    # The items of the last part may end in any state: the lightest sound one is the goal.
    goals = [x[1:] for x in (items or {START: [(START, 0, "")]}).get(START, ()) if x[0] in SOUND]
    out["cost"], out["audit"] = min(goals)
    return out


# ---------------------------------------------------------------- Spark

def prepared(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv_id, turn, role, text, copies): the rows with null roles and texts as one space."""
    c = conversations
    return c.select(c[conv_col].alias("conv_id"), c[turn_col].cast("long").alias("turn"), F.coalesce(c[role_col].cast("string"), F.lit(" ")).alias("role"),
                    F.coalesce(c[text_col].cast("string"), F.lit(" ")).alias("text"), F.lit(1).alias("copies"))


def damaged(rows: DataFrame) -> DataFrame:
    """Rows of ``prepared`` with test damage by crc32(``conv_id:turn``) % 20: 0 drops a row (copies 0), 1 empties its
    text, 2 takes its ``.!?``, 3 repeats it, 4 makes it the user's."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(key.cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                       F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


def _tied(rows: DataFrame) -> DataFrame:
    """With ``tie``: the digest of (role, text), which also orders the rows of a turn."""
    whole = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.lit(":"), F.col("text"))
    return rows.withColumn("tie", F.unhex(F.sha2(whole.cast("binary"), 256)))


def _parts(tied: DataFrame) -> DataFrame:
    """One row per conversation and partition: its order key, counts, end initials, turns and items."""
    bare = F.rtrim("text", F.lit(SPACE))
    facts = [F.substring("role", 1, 1).alias("initial"), (bare == "").alias("blank"), (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("truncated")]
    slim = written(tied.filter("copies > 0").select("conv_id", "turn", "tie", "copies", *facts).groupBy("conv_id", "turn", "tie").agg(
        F.sum("copies").cast("int").alias("copies"), *[F.first(c).alias(c) for c in ("initial", "blank", "truncated")]), "turns")
    at = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    firsts = slim.groupBy(F.col("conv_id").alias("c"), F.col("tie").alias("t")).agg(F.min(at).alias("at"))
    marked = slim.join(firsts, slim.conv_id.eqNullSafe(firsts.c) & (slim.tie == firsts.t) & slim.turn.eqNullSafe(firsts["at"]["turn"]), "left")
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("tie")]
    dealt = written(marked.select("conv_id", "turn", "tie", "copies", "initial", F.col("t").isNotNull().alias("first"), "blank", "truncated"),
                    "marked-turns").repartitionByRange(*order).sortWithinPartitions(*order)
    kind = to_arrow_type(slim.schema["conv_id"].dataType)
    names = ["conv_id", "turn", "tie", "copies", "initial", "first", "blank", "truncated"]
    fields = pa.schema([("conv_id", kind), ("turn", pa.int64()), ("tie", pa.binary()), *[(c, pa.int64()) for c in _COUNTS],
                        ("first", pa.string()), ("last", pa.string()), ("low", pa.int64()), ("high", pa.int64()), ("turns", pa.int64()),
                        ("p", pa.list_(pa.int32())), ("q", pa.list_(pa.int32())), ("cost", pa.list_(pa.int64())), ("audit", pa.list_(pa.string()))])

    def derive(batches):
        part, nth = None, 0

        def close(whole):
            items = part.items(whole)
            return {"conv_id": part.conv, "turn": part.key[0], "tie": part.key[1], **part.counts, "first": part.first, "last": part.last,
                    "low": part.low, "high": part.high, "turns": part.turns, "p": [p for p, _ in items], "q": [q for _, q in items],
                    "cost": [c for c, _ in items.values()], "audit": [a for _, a in items.values()]}

        for b in batches:
            out = []
            for conv, turn, tie, *rest in zip(*[b.column(c).to_pylist() for c in names]):
                if part is None or conv != part.conv:
                    if part is not None:  # neither the partition's first conversation nor its last is known to be whole
                        out.append(close(nth > 1))
                    nth += 1
                    part = Part(conv, (turn, tie), nth > 1)
                part.add(turn, *rest)
            yield pa.RecordBatch.from_pylist(out, fields)
        if part is not None:
            yield pa.RecordBatch.from_pylist([close(False)], fields)

    schema = ("conv_id " + slim.schema["conv_id"].dataType.simpleString() + ", turn long, tie binary, " + ", ".join(f"{c} long" for c in _COUNTS)
              + ", first string, last string, low long, high long, turns long, p array<int>, q array<int>, cost array<long>, audit array<string>")
    return written(dealt.mapInArrow(derive, schema), "conversation-parts")


_PART = [*_COUNTS, "first", "last", "low", "high", "turns", "p", "q", "cost", "audit"]


class _Conversation:
    """One conversation of the last stream: its parts, then its rows against the audit."""

    def __init__(self, conv):
        self.conv, self.parts, self.facts = conv, [], None
        self.at, self.seq, self.spoken, self.sha = 0, 0, START, hashlib.sha256()

    def _say(self, role, text, edit, rows):
        self.sha.update(("\n" if self.seq else "").encode() + f"{role}:{text}".encode())
        if rows is not None:
            rows.append((self.conv, self.seq, role, text, edit))
        self.seq += 1

    def _inserted(self, rows):
        while self.at < len(self.facts["audit"]) and self.facts["audit"][self.at] == "I":
            self.at += 1
            self.spoken = SPOKEN[self.spoken]
            self._say(ROLE[self.spoken], "", "I", rows)

    def start(self):
        if self.facts is None:
            self.facts = join_parts(self.parts)
            self.parts = []

    def row(self, role, text, copies, rows):
        self.start()
        for _ in range(copies):
            self._inserted(rows)
            edit = self.facts["audit"][self.at]
            self.at += 1
            if edit == "D":
                continue
            if edit == "K" and role[:1] == "s":
                self.spoken = SYSTEM
            elif edit != "K" or role:
                self.spoken = SPOKEN[self.spoken]
            self._say(role if edit == "K" else ROLE[self.spoken], text, edit, rows)

    def finish(self, rows):
        self.start()
        self._inserted(rows)
        f = self.facts
        return (self.conv, f["gaps"], *[f[c] for c in _COUNTS], f["cost"], f["audit"], self.sha.hexdigest())


def _stream(rows: DataFrame, report: bool) -> DataFrame:
    tied = _tied(rows)
    parts = _parts(tied)
    texts = tied.select("conv_id", "turn", "tie", "copies", F.when(F.col("copies") > 0, F.col("role")).alias("role"),
                        F.when(F.col("copies") > 0, F.col("text")).alias("text"), F.lit(1).alias("kind"))
    both = texts.unionByName(parts.withColumn("kind", F.lit(0)), allowMissingColumns=True)
    met = both.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "kind", F.col("turn").asc_nulls_first(), "tie")
    kind = tied.schema["conv_id"].dataType
    reported = pa.schema([("conv_id", to_arrow_type(kind)), ("gaps", pa.int64()), *[(c, pa.int64()) for c in _COUNTS], ("cost", pa.int64()),
                          ("audit", pa.string()), ("repaired_sha256", pa.string())])
    repaired = pa.schema([("conv_id", to_arrow_type(kind)), ("seq", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())])
    fields = reported if report else repaired

    def table(out):
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(list(zip(*out)) or [()] * len(fields), fields)], schema=fields)

    def read(batches):
        conv = None
        for b in batches:
            done, said = [], None if report else []
            is_part = b.column("kind").to_pylist()
            plain = [b.column(c).to_pylist() for c in ("conv_id", "copies", "role", "text")]
            for i, (c, copies, role, text) in enumerate(zip(*plain)):
                if conv is None or c != conv.conv:
                    if conv is not None:
                        done.append(conv.finish(said))
                    conv = _Conversation(c)
                if is_part[i] == 0:
                    conv.parts.append({n: b.column(n)[i].as_py() for n in _PART})
                else:
                    conv.row(role, text, copies, said)
            yield table(done if report else said)
        if conv is not None:
            said = None if report else []
            done = [conv.finish(said)]
            yield table(done if report else said)

    schema = f"conv_id {kind.simpleString()}, " + (
        "gaps long, " + ", ".join(f"{c} long" for c in _COUNTS) + ", cost long, audit string, repaired_sha256 string"
        if report else "seq long, role string, text string, edit string")
    return met.mapInArrow(read, schema)


def repair_report(conversations: DataFrame, damage: bool = False, conv_col: str = "conv_id", turn_col: str = "turn",
                  role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256: one row per conversation.

    A null conversation id is one of its own; null roles and texts count as one space (so such texts
    are blank), null turns come first and have no part in gaps.  A conversation without rows (after ``damage``)
    has zeros, an empty audit and the digest of the empty string.  Other columns are not read.
    """
    small_batches(conversations.sparkSession)
    rows = prepared(conversations, conv_col, turn_col, role_col, text_col)
    return _stream(damaged(rows) if damage else rows, True)


def repaired_rows(conversations: DataFrame, damage: bool = False, conv_col: str = "conv_id", turn_col: str = "turn",
                  role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, seq, role, text, edit: the repaired conversations row by row; ``edit`` is K, R or I."""
    small_batches(conversations.sparkSession)
    rows = prepared(conversations, conv_col, turn_col, role_col, text_col)
    return _stream(damaged(rows) if damage else rows, False)
