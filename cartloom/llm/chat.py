"""Chat formatting: messages rebuilt from an event log, then rendered with a loss mask.

The log has one row per event: conversation, sequence, message, kind, role, text. Kinds:

* ``start`` opens a message and gives its role;
* ``delta`` appends a streamed piece of text;
* ``edit`` replaces the text so far;
* ``regenerate`` discards the text so far, and deltas follow anew.

Logs are partitioned by conversation, sorted by sequence and folded to final messages, which are
rendered as ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside texts and roles a backslash is doubled
and ``<|`` becomes ``<\\p``; a line feed in a role becomes ``<\\n``. That is reversible, and no text
can forge a control string. The loss mask holds the places of the assistant texts.

A log that is already partitioned by conversation is not exchanged again: folding, offsets and
rendering all keep to that partitioning.

Edge cases: null texts and roles are empty; messages of one place are ordered by role and text,
and repeated rows stay messages of their own; a null conversation id is a conversation of its
own; an empty log gives no rows. A conversation is one output value, so its size is bounded by
what one string may hold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END, LOSS_ROLE = "<|im_start|>", "<|im_end|>", "assistant"


def _escape(column: str) -> str:
    return f"replace(replace({column}, r'\\', r'\\\\'), '<|', r'<\\p')"


def _unescape(column: str) -> str:
    return f"replace(replace({column}, r'<\\p', '<|'), r'\\\\', r'\\')"


def messages_as_events(turns: DataFrame, piece: int = 400) -> DataFrame:
    """An event log for a table of finished turns: each text is streamed in pieces.

    An assistant's first piece is streamed, discarded and generated again, a user's is first sent
    with a stray character and then edited; the fold has to undo both.
    """
    numbered = turns.select(
        "conv_id",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.expr("row_number() over (partition by conv_id order by turn, coalesce(role, ''), coalesce(text, ''))").alias("message"),
    )
    piece_of = f"substring(text, k * {piece} + 1, {piece})"
    streamed = f"transform(sequence(0, greatest(0, cast(ceil(length(text) / {piece}) as int) - 1)), k -> struct('delta' as kind, {piece_of} as part))"
    event = "struct('{}' as kind, {} as part)"
    events = F.expr(
        f"concat(array({event.format('start', chr(39) * 2)}), case "
        f"when role = '{LOSS_ROLE}' then concat(array({event.format('delta', 'substring(text, 1, 7)')}, "
        f"{event.format('regenerate', chr(39) * 2)}), {streamed}) "
        f"when role = 'user' then array({event.format('delta', 'concat(text, chr(42))')}, {event.format('edit', 'text')}) "
        f"else {streamed} end)"
    )
    rows = numbered.select("conv_id", "message", "role", F.posexplode(events).alias("step", "event"))
    return rows.select(
        "conv_id",
        F.struct("message", "step").alias("seq"),
        "message",
        F.col("event.kind").alias("kind"),
        "role",
        F.col("event.part").alias("text"),
    )


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, message, role, text): what stands after the last edit or restart."""
    log = "collect_list(struct(seq, kind, coalesce(role, '') as role, coalesce(text, '') as text))"
    grouped = events.groupBy("conv_id", "message").agg(F.expr(f"sort_array({log})").alias("log"))
    base = grouped.withColumn(
        "base",
        F.expr("array_max(transform(log, (e, i) -> case when e.kind in ('start', 'edit', 'regenerate') then i else 0 end))"),
    )
    return base.select(
        "conv_id",
        "message",
        F.expr("array_max(transform(log, e -> case when e.kind = 'start' then e.role else '' end))").alias("role"),
        F.expr("array_join(transform(slice(log, base + 1, size(log)), e -> e.text), '')").alias("text"),
        F.expr("log[0].seq").alias("first_seq"),
    )


def render(messages: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_spans): spans are (start, length) in code points of ``formatted``."""
    safe_role = f"replace({_escape('role')}, char(10), r'<\\n')"
    parts = messages.select(
        "conv_id",
        "first_seq",
        F.expr(f"concat('{START}', {safe_role}, char(10))").alias("head"),
        F.expr(_escape("text")).alias("body"),
        (F.col("role") == LOSS_ROLE).alias("loss"),
    )
    whole = parts.withColumn("turn", F.expr(f"concat(head, body, '{END}', char(10))"))
    placed = whole.withColumn(
        "start",
        F.expr(
            "coalesce(sum(length(turn)) over (partition by conv_id order by first_seq "
            "rows between unbounded preceding and 1 preceding), 0) + length(head)"
        ),
    ).select(
        "conv_id",
        F.struct(
            "first_seq", "turn", "loss", "start", F.length("body").cast("long").alias("size")
        ).alias("m"),
    )
    grouped = placed.groupBy("conv_id").agg(F.expr("sort_array(collect_list(m))").alias("ms"))
    return grouped.select(
        "conv_id",
        F.expr("array_join(transform(ms, m -> m.turn), '')").alias("formatted"),
        F.expr("transform(filter(ms, m -> m.loss), m -> struct(m.start as start, m.size as length))").alias("loss_spans"),
    )


def format_chats(events: DataFrame) -> DataFrame:
    """Rendered conversations from an event log."""
    return render(fold_events(events))


def read_back(formatted: DataFrame) -> DataFrame:
    """Adds ``turns``: (role, text) per message, parsed from the rendered string alone."""
    cut = f"split(formatted, '{END.replace('|', '[|]')}\\n')"
    pieces = f"filter({cut}, p -> p <> '')"
    body = f"substring(p, {len(START) + 1})"
    role = f"replace(substring_index({body}, '\\n', 1), r'<\\n', char(10))"
    text = f"substring({body}, instr({body}, '\\n') + 1)"
    return formatted.withColumn("turns", F.expr(f"transform({pieces}, p -> struct({_unescape(role)} as role, {_unescape(text)} as text))"))


def loss_text(formatted: str = "formatted", spans: str = "loss_spans"):
    """All text under the loss mask: the spans cut out of the rendered string, unescaped."""
    cut = f"substring({formatted}, cast(s.start as int) + 1, cast(s.length as int))"
    return F.expr(f"array_join(transform({spans}, s -> {_unescape(cut)}), '')")
