"""Repair of conversation structure by weighted CYK parsing over spans of rows.

A conversation is well formed if its role initials spell ``(s?(ua)+)?``. Written as a grammar over
the states 0 (nothing yet), 1 (after s), 2 (after u) and 3 (after a), in Chomsky normal form:

    N(p,q) -> N(p,r) N(r,q)          for all states: two neighbouring spans
    N(p,q) -> row                    keep (0), rerole (1) or delete (2); 5 more for a truncated row that stays
    S -> N(0,0) | N(0,3)             the accepted spans

Inserted rows (5 each) form the closure of the empty span, which is taken once on either side of
every row. The cell of a span holds, for each N(p,q), the least (cost, audit). A derivation of this
grammar can be cut between any two rows, so one cut of a span into neighbours gives its whole cell:
spans of length 1 are combined to spans of 2, 4, 8, ... and n rows need n - 1 combinations. Among
equal costs no audit is the beginning of another one of the same cell (what follows would be
inserted rows, which cost), so the least audit of a span is made of least audits of its parts.

On Spark: equal rows are counted first, whatever their number. Rows are sorted by conversation and
turn over range partitions, so that a conversation with a large share of all rows is cut over many
tasks, which parse *pieces* of bounded size. Conversations inside a task are finished there. The
others (those at the edges of a partition, or long ones) go on as cells: ``FAN_IN`` neighbouring
pieces are combined in each round, then every piece learns the states at its two ends.

Edge cases: null roles and texts count as one space (so such rows are blank or need a role); rows
without a turn come first; rows of equal turn are ordered by role, then by a digest of the text; an
empty table gives no pieces; other columns are not looked at. A text is never cut; an audit or the
rows of one piece must fit into one value (2 GB).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartloom.llm.tables import Scratch

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
#: Costs of the edits, and what a truncated row that stays costs more.
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 1, 2, 5, 5
#: Where each initial leads from each state; and the states that end a well-formed conversation.
MOVES = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ACCEPTED = (0, 3)
ROLES = {"u": "user", "a": "assistant"}

#: A piece ends at so many different rows or characters (a longer text is a piece of its own).
PIECE_ROWS, PIECE_CHARS = 1024, 1_000_000
FAN_IN = 64

#: (cost, audit, states at the inner edges of pieces) by (state before, state after).
Cell = dict[tuple[int, int], tuple[int, str, str]]


def _closure() -> Cell:
    """The empty span: the cheapest inserted rows between any two states."""
    cell = {(p, p): (0, "", "") for p in range(4)}
    for _ in range(4):
        for (p, q), (cost, audit, _path) in list(cell.items()):
            for (state, initial), after in MOVES.items():
                longer = (cost + INSERT_COST, audit + INSERT, "")
                if state == q and initial in ROLES and longer < cell.get((p, after), (1 << 60,)):
                    cell[p, after] = longer
    return cell


def join_spans(left: Cell, right: Cell) -> Cell:
    """The cell of two neighbouring spans: all binary rules."""
    out: Cell = {}
    for (p, r), (cost, audit, path) in left.items():
        for q in range(4):
            other = right.get((r, q))
            if other is not None:
                found = (cost + other[0], audit + other[1], path + other[2])
                if (p, q) not in out or found < out[p, q]:
                    out[p, q] = found
    return out


EMPTY = _closure()


def row_cell(initial: str, alive: bool, truncated: bool, copies: int = 1) -> Cell:
    """The cell of one row with the closure around it; rows not ``alive`` are deleted, all copies at once."""
    cell: Cell = {(p, p): (DELETE_COST * copies, DELETE * copies, "") for p in range(4)}
    if alive:
        stays = TRUNCATED_COST if truncated else 0
        for (p, start), q in MOVES.items():
            for kept, found in ((start == initial, (stays, KEEP, "")), (start in ROLES, (stays + REROLE_COST, REROLE, ""))):
                if kept and ((p, q) not in cell or found < cell[p, q]):
                    cell[p, q] = found
    return join_spans(join_spans(EMPTY, cell), EMPTY)


def parse(spans: list[Cell]) -> Cell:
    """The cell of a whole sequence, bottom-up: spans of 1, 2, 4, ... neighbours."""
    while len(spans) > 1:
        pairs = [join_spans(spans[i], spans[i + 1]) for i in range(0, len(spans) - 1, 2)]
        spans = pairs + spans[len(spans) // 2 * 2 :]
    return spans[0] if spans else EMPTY


def best(cell: Cell) -> tuple[int, str, str, int]:
    """The accepted (cost, audit, path) and its last state."""
    return min((*cell[0, q], q) for q in ACCEPTED if (0, q) in cell)


def apply_audit(audit: str, state: int, alive: str, roles: list[str], texts: list[str]) -> list[dict]:
    """The rows that the edits leave. ``alive`` tells by row (1 or 0) which ones have a role and text."""
    out, row, live = [], 0, 0
    for edit in audit:
        if edit == INSERT:
            role, text = ROLES["u" if (state, "u") in MOVES else "a"], ""
        else:
            here = alive[row] == "1"
            row, live = row + 1, live + here
            if edit == DELETE:
                continue
            text = texts[live - 1]
            role = roles[live - 1] if edit == KEEP else ROLES["u" if (state, "u") in MOVES else "a"]
        out.append({"role": role, "text": text})
        state = MOVES[state, role[:1]]
    return out


# Statistics of a run of rows, and how two neighbouring runs add up.
STATS = ("blank", "duplicate", "truncated", "illegal", "n_turns", "min_turn", "max_turn", "first_turn", "last_turn", "first_initial", "last_initial")
LEGAL = ("su", "ua", "au")
EDGE = ("min_turn", "max_turn")


def add_stats(a: dict, b: dict) -> dict:
    out = {k: a[k] + b[k] for k in ("blank", "duplicate", "truncated", "illegal", "n_turns")}
    out["illegal"] += a["last_initial"] + b["first_initial"] not in LEGAL
    out["n_turns"] -= b["first_turn"] is not None and a["last_turn"] == b["first_turn"]
    for k, pick in zip(EDGE, (min, max), strict=True):
        out[k] = pick((x for x in (a[k], b[k]) if x is not None), default=None)
    out.update({k: s[k] for s, edge in ((a, "first"), (b, "last")) for k in (f"{edge}_turn", f"{edge}_initial")})
    return out


def _row_stats(row: dict) -> dict:
    initial, turn, n = row["role"][:1], row["turn"], row["copies"]
    blank, first = row["blank"], row["is_first"]
    return {
        "blank": n if blank else 0,
        "duplicate": 0 if blank else n - first,
        "truncated": int(not blank and first and row["cut_off"]),
        # Copies follow one another, and no initial may follow itself.
        "illegal": n - 1,
        "n_turns": int(turn is not None),
        **dict.fromkeys(("min_turn", "max_turn", "first_turn", "last_turn"), turn),
        **dict.fromkeys(("first_initial", "last_initial"), initial),
    }


def _gaps(stats: dict) -> int:
    return 0 if stats["min_turn"] is None else stats["max_turn"] - stats["min_turn"] + 1 - stats["n_turns"]


_MESSAGES = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
_PIECE = pa.schema(
    [
        ("conv", pa.int64()), ("open", pa.bool_()), ("part", pa.int32()), ("seq", pa.int64()),
        *[(k, pa.string() if k.endswith("initial") else pa.int64()) for k in STATS],
        ("costs", pa.list_(pa.int64())), ("audits", pa.list_(pa.string())), ("paths", pa.list_(pa.string())),
        ("alive", pa.string()), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())),
        ("cost", pa.int64()), ("audit", pa.string()), ("messages", _MESSAGES),
    ]
)


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int64(): "long", pa.int32(): "int", pa.string(): "string", pa.bool_(): "boolean"}
    names |= {pa.list_(pa.int64()): "array<long>", pa.list_(pa.string()): "array<string>", _MESSAGES: "array<struct<role:string,text:string>>"}
    return ", ".join(f"`{f.name}` {names[f.type]}" for f in schema)


def _cell_columns(cell: Cell) -> dict:
    entries = [cell.get((p, q)) for p in range(4) for q in range(4)]
    return {name: [e and e[i] for e in entries] for i, name in enumerate(("costs", "audits", "paths"))}


def _cell_of(row: dict) -> Cell:
    entries = zip(row["costs"], row["audits"], row["paths"], strict=True)
    return {divmod(i, 4): e for i, e in enumerate(entries) if e[0] is not None}


def _records(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            yield from batch.slice(start, 256).to_pylist()


def _batches(rows: Iterable[dict], schema: pa.Schema, size: int = 256) -> Iterator[pa.RecordBatch]:
    held, weight = [], 0
    for row in rows:
        held.append({f.name: row.get(f.name) for f in schema})
        weight += 1 + sum(len(t) for t in row.get("texts") or ()) // 10_000
        if weight >= size:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def _piece(rows: list[dict], seq: int, part: int) -> dict:
    stats = None
    for row in rows:
        one = _row_stats(row)
        stats = one if stats is None else add_stats(stats, one)
    live = [not r["blank"] and r["is_first"] for r in rows]
    spans = []
    for row, here in zip(rows, live, strict=True):
        if here:
            spans.append(row_cell(row["role"][:1], True, row["cut_off"]))
        if row["copies"] > here:
            spans.append(row_cell("", False, False, row["copies"] - here))
    alive = "".join("1" * here + "0" * (r["copies"] - here) for r, here in zip(rows, live, strict=True))
    kept = [r for r, here in zip(rows, live, strict=True) if here]
    return {
        "conv": rows[0]["conv"], "part": part, "seq": seq, **stats, "cell": parse(spans),
        "alive": alive, "roles": [r["role"] for r in kept], "texts": [r["text"] for r in kept],
    }


def _parse_sorted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order to pieces; conversations wholly inside are finished."""
    part = TaskContext.get().partitionId()

    def pieces() -> Iterator[tuple[dict, bool]]:
        """(piece, whether it starts its conversation here)"""
        rows, chars, seq, fresh, conv = [], 0, 0, True, None
        for row in _records(batches):
            if rows and (row["conv"] != conv or len(rows) >= PIECE_ROWS or chars + len(row["text"]) > PIECE_CHARS):
                yield _piece(rows, seq, part), fresh
                fresh, seq = row["conv"] != conv, seq + 1
                rows, chars = [], 0
            conv = row["conv"]
            rows.append(row)
            chars += len(row["text"])
        if rows:
            yield _piece(rows, seq, part), fresh

    def decided() -> Iterator[dict]:
        # A piece is whole if others follow and precede it in the task and none of them is of its conversation.
        held, held_fresh, first = None, False, True
        for piece, fresh in pieces():
            if held is not None:
                yield finish(held, whole=held_fresh and fresh and not first)
                first = False
            held, held_fresh = piece, fresh
        if held is not None:
            yield finish(held, whole=False)

    def finish(piece: dict, whole: bool) -> dict:
        cell = piece.pop("cell")
        if not whole:
            ends = {(p, q): (cost, audit, str(q)) for (p, q), (cost, audit, _) in cell.items()}
            return {**piece, **_cell_columns(ends), "open": True}
        cost, audit, _, _ = best(cell)
        messages = apply_audit(audit, 0, piece.pop("alive"), piece.pop("roles"), piece.pop("texts"))
        return {**piece, "open": False, "cost": cost, "audit": audit, "messages": messages}

    yield from _batches(decided(), _PIECE)


_SPAN = pa.schema([f for f in _PIECE if f.name in ("conv", *STATS, "costs", "audits", "paths")] + [pa.field("place", pa.int64())])


def _combine(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans sorted by conversation and place, to one span per ``FAN_IN`` neighbours."""

    def groups() -> Iterator[dict]:
        held, key = [], None
        for row in _records(batches):
            here = (row["conv"], row["place"] // FAN_IN)
            if held and here != key:
                yield joined(held, key)
                held = []
            held.append(row)
            key = here
        if held:
            yield joined(held, key)

    def joined(rows: list[dict], key: tuple) -> dict:
        stats = rows[0]
        for row in rows[1:]:
            stats = add_stats(stats, row)
        return {"conv": key[0], "place": key[1], **{k: stats[k] for k in STATS}, **_cell_columns(parse([_cell_of(r) for r in rows]))}

    yield from _batches(groups(), _SPAN)


_DONE = pa.schema(
    [("conv", pa.int64()), ("gaps", pa.int64()), *[(k, pa.int64()) for k in STATS[:4]], ("cost", pa.int64()), ("audit", pa.string()), ("path", pa.string())]
)


def _accept(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def done() -> Iterator[dict]:
        for row in _records(batches):
            cost, audit, path, _ = best(_cell_of(row))
            yield {**row, "gaps": _gaps(row), "cost": cost, "audit": audit, "path": path}

    yield from _batches(done(), _DONE)


_APPLIED = pa.schema([("conv", pa.int64()), ("place", pa.int64()), ("messages", _MESSAGES)])


def _apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Open pieces with the states at their ends (``enters``, ``leaves``) to the rows that stay."""

    def applied() -> Iterator[dict]:
        for row in _records(batches):
            audit = row["audits"][row["enters"] * 4 + row["leaves"]]
            yield {**row, "messages": apply_audit(audit, row["enters"], row["alive"], row["roles"], row["texts"])}

    yield from _batches(applied(), _APPLIED)


def repair_conversations(
    rows: DataFrame, conv_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role", text_column: str = "text"
) -> DataFrame:
    """The repaired conversations in pieces of bounded size, with the faults found and the edits made.

    One row per piece: the conversation's id, ``piece`` (from 0), ``n_pieces`` and ``messages`` (role
    and text, in order). Piece 0 also holds gaps, blank, duplicate, truncated, illegal, cost and audit
    of the whole conversation; they are null in later pieces. Ids and turns are whole numbers.
    """
    scratch = Scratch(rows.sparkSession, "repair")
    given = rows.select(
        F.col(conv_column).cast("long").alias("conv"),
        F.col(turn_column).cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(n) for c, n in ((role_column, "role"), (text_column, "text"))],
    )
    key = ["conv", "turn", "role", "digest"]
    distinct = given.withColumn("digest", F.unhex(F.sha2("text", 256))).groupBy(*key).agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    # The first turn of each text in its conversation; joined by the whole key, so no text is a hot key.
    names = ", ".join(f"{c} as first_{c}" for c in key)
    firsts = distinct.groupBy("conv", "role", "digest").agg(F.min(F.struct("turn")).alias("at")).selectExpr("*", "at.turn as turn").selectExpr(*names.split(", "))
    shared = F.expr(" and ".join(f"{c} <=> first_{c}" for c in key))
    flagged = distinct.join(firsts, shared, "left").select(*key, "text", "copies", F.col("first_digest").isNotNull().alias("is_first"))
    judged = flagged.withColumns(
        {
            "blank": F.expr(r"not text rlike '[^\\x20\\x09-\\x0D]'"),
            "cut_off": F.expr(r"not text rlike '[.!?][\\x20\\x09-\\x0D]*\\z'"),
        }
    )
    ordered = judged.repartitionByRange(*key).sortWithinPartitions(*key).drop("digest")
    pieces = scratch.keep(ordered.mapInArrow(_parse_sorted, _ddl(_PIECE)))

    gaps = F.expr("coalesce(max_turn - min_turn + 1 - n_turns, 0L)")
    whole = pieces.where("not open").select(
        "conv", F.lit(0).cast("long").alias("piece"), F.lit(1).cast("long").alias("n_pieces"), gaps.alias("gaps"), *STATS[:4], "cost", "audit", "messages"
    )
    numbered = "row_number() over (partition by conv order by part, seq) - 1"
    opened = scratch.keep(pieces.where("open").withColumn("place", F.expr(f"cast({numbered} as long)")))
    spans = opened.select(*_SPAN.names)
    while (spans.agg(F.max("place")).first()[0] or 0) > 0:
        near = spans.repartition("conv", F.expr(f"place div {FAN_IN}")).sortWithinPartitions("conv", "place")
        spans = scratch.keep(near.mapInArrow(_combine, _ddl(_SPAN)))
    done = scratch.keep(spans.mapInArrow(_accept, _ddl(_DONE)))
    # The path of a conversation holds the state after each of its pieces.
    digits = "posexplode(transform(sequence(1, length(path)), i -> cast(substring(path, i, 1) as int))) as (at, leaves)"
    before = "coalesce(lag(leaves) over (partition by c order by at), 0) as enters"
    ends = done.selectExpr("conv as c", "cast(length(path) as long) as n_pieces", digits).selectExpr("*", before)
    states = opened.join(ends, F.expr("conv <=> c and place = at"))
    applied = states.mapInArrow(_apply, _ddl(_APPLIED))
    counts = ends.where("at = 0").select("c", "n_pieces").join(done, F.expr("conv <=> c")).drop("conv", "path")
    parts = applied.join(counts, F.expr("conv <=> c"), "left").select(
        "conv", F.col("place").alias("piece"), "n_pieces",
        *[F.expr(f"if(place = 0, {c}, null)").alias(c) for c in ("gaps", *STATS[:4], "cost", "audit")], "messages",
    )
    return whole.unionByName(parts).withColumnRenamed("conv", conv_column)


def repaired_digests(pieces: DataFrame, conv_column: str = "conv_id") -> DataFrame:
    """(conv, sha256): digest of the repaired ``role:text``, one per line.

    The digest of a conversation in several pieces is taken over them in order by one task, which
    holds one piece at a time; all others are taken where they are.
    """
    lines = "concat_ws('\\n', transform(messages, m -> concat(m.role, ':', m.text)))"
    given = pieces.select(F.col(conv_column).alias("conv"), "piece", "n_pieces", F.size("messages").alias("n"), F.expr(lines).alias("lines"))
    alone = given.where("n_pieces = 1").select("conv", F.sha2("lines", 256).alias("sha256"))
    several = given.where("n_pieces > 1").repartition("conv").sortWithinPartitions("conv", "piece").select("conv", "piece", "n", "lines")
    schema = pa.schema([("conv", pa.int64()), ("sha256", pa.string())])

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def digests() -> Iterator[dict]:
            state, conv, empty = None, None, True
            for row in _records(batches):
                if row["piece"] == 0:
                    if state is not None:
                        yield {"conv": conv, "sha256": state.hexdigest()}
                    state, conv, empty = hashlib.sha256(), row["conv"], True
                if row["n"]:
                    state.update(("" if empty else "\n").encode() + row["lines"].encode())
                    empty = False
            if state is not None:
                yield {"conv": conv, "sha256": state.hexdigest()}

        yield from _batches(digests(), schema)

    return alone.unionByName(several.mapInArrow(digest, _ddl(schema))).withColumnRenamed("conv", conv_column)


def damage(rows: DataFrame, conv_column: str = "conv_id", turn_column: str = "turn") -> DataFrame:
    """(conv_id, turn, role, text) damaged by a checksum of ``conv_id:turn``: one of 20 drops the row, one empties the
    text, one takes ``.!?`` out of it, one repeats the row and one sets its role to user. Nulls count as one space."""
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv_column, turn_column, "role", "text")}
    mark = F.pmod(F.crc32(F.concat(text[conv_column], F.lit(":"), text[turn_column])), F.lit(20))
    marked = rows.select(F.col(conv_column).alias("conv_id"), F.col(turn_column).alias("turn"), text["role"].alias("role"), text["text"].alias("text"), mark.alias("mark"))
    return marked.where("mark <> 0").select(
        "conv_id",
        "turn",
        F.expr("if(mark = 4, 'user', role)").alias("role"),
        F.expr("case mark when 1 then '' when 2 then regexp_replace(text, '[.!?]', '') else text end").alias("text"),
        F.expr("explode(if(mark = 3, array(0, 1), array(0)))").alias("copy"),
    ).drop("copy")
