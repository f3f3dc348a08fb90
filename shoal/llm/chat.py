"""Chat formatting: conversations kept as event logs are folded into their final messages and
rendered with a template; the loss mask covers the assistant's texts.

A log has the columns ``conv_id, turn, message, seq, kind, role, text``.  ``seq`` orders the
events of a conversation, ``message`` names a message in it, ``turn`` is its place.  Kinds:

``open``        the message begins, with its role (and ``text``, if it isn't null)
``delta``       ``text`` is added to the message
``edit``        ``text`` takes the place of all the message says so far
``regenerate``  as ``edit``, and messages behind it that were open by then are gone

The fold: the log is dealt by conversation (the one shuffle), a message's events are grouped
and put in order of ``seq``, and its text is what stands at or after its last open, edit or
regenerate; a window over the messages, by turn, finds those that an earlier turn's
regeneration has swept away.  All of it are DataFrame functions.  A task streams its
conversations; what it holds at once is one conversation, as the result is one row each.

Defined results: a null text adds nothing; events delivered twice count once; events of a
message that never opened are left out, and a conversation without open messages has no row;
messages on the same turn stand in the order of ``message``; a null conversation id is a
conversation, a null turn stands first; a null role is the role ``""``; an empty log gives an
empty table; other columns are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, DELTA, EDIT, REGENERATE = "open", "delta", "edit", "regenerate"


@dataclass(frozen=True)
class Template:
    """Marks of the turns.  A role without marks of its own is written out between ``role``
    marks.  Every mark is one opening bracket and a rest without opening brackets."""

    begin: str = "<s>"
    marks: tuple[tuple[str, str, str], ...] = (
        ("system", "[SYSTEM_PROMPT]", "[/SYSTEM_PROMPT]"), ("user", "[INST]", "[/INST]"), ("assistant", "", "</s>"))
    role: tuple[str, str, str] = ("[ROLE]", "[/ROLE]", "[/TURN]")
    loss_role: str = "assistant"

    @property
    def controls(self) -> list[str]:
        """All control strings, longest first."""
        used = {self.begin, *self.role, *(m for _, a, b in self.marks for m in (a, b) if m)}
        return sorted(used, key=lambda m: (-len(m), m))

    def _rests(self) -> str:
        return "|".join(re.escape(m[1:]) for m in self.controls)

    @property
    def _opening(self) -> str:
        return "[" + "".join(re.escape(c) for c in sorted({m[0] for m in self.controls})) + "]"

    def escape(self, text: Column) -> Column:
        """A control string gets a backslash behind its bracket, one that has k there gets one
        more: no control string is left, and ``unescape`` gives back the text exactly."""
        return F.regexp_replace(text, f"({self._opening})(\\\\*(?:{self._rests()}))", r"$1\\$2")

    def unescape(self, text: Column) -> Column:
        return F.regexp_replace(text, f"({self._opening})\\\\(\\\\*(?:{self._rests()}))", "$1$2")

    def segments(self, turn: Column) -> Column:
        """A turn (role, text) as segments (text, loss)."""
        part = lambda text, loss=False: F.struct(text.alias("text"), F.lit(loss).alias("loss"))
        body = self.escape(turn["text"])
        a, b, c = (F.lit(m) for m in self.role)
        out = F.array(part(F.concat(a, self.escape(turn["role"]), b, body, c)))
        for role, start, end in self.marks:
            if role == self.loss_role:
                own = F.array(part(F.lit(start)), part(body, True), part(F.lit(end)))
            else:
                own = F.array(part(F.concat(F.lit(start), body, F.lit(end))))
            out = F.when(turn["role"] == role, own).otherwise(out)
        return out

    def turns(self, formatted: Column) -> Column:
        """The turns (role, text) of a formatted conversation, read back from the text alone: no
        text holds a mark, so each match of the marks is one turn."""
        named = ("", self.role[0], self.role[2])
        marked = [m for m in self.marks if m[1]] + [named]
        bare = [m for m in self.marks if not m[1]]  # tried last: its match could begin anywhere
        kinds = "|".join(f"{re.escape(a)}.*?{re.escape(b)}" for _, a, b in marked + bare)
        pieces = F.regexp_extract_all(F.substr(formatted, F.lit(len(self.begin) + 1)), F.lit(f"(?s)({kinds})"), F.lit(1))

        def one(x: Column) -> Column:
            turn = F.lit(None)
            for role, a, b in bare + marked:
                body = F.substr(x, F.lit(len(a) + 1), F.length(x) - len(a) - len(b))
                name = F.lit(role)
                if (role, a, b) == named:
                    name = F.substring_index(body, self.role[1], 1)
                    body = F.substr(body, F.length(name) + len(self.role[1]) + 1)
                own = F.struct(self.unescape(name).alias("role"), self.unescape(body).alias("text"))
                turn = F.when(F.startswith(x, F.lit(a)), own).otherwise(turn)
            return turn

        return F.transform(pieces, one)


def fold(log: DataFrame) -> DataFrame:
    """(conv_id, turn, message, role, text) of the messages that stand at the end of the log.
    The rows are dealt by conversation."""
    seq, kind = F.col("seq"), F.col("kind")
    at = lambda *kinds: F.when(kind.isin(*kinds), seq)
    events = log.select("conv_id", "turn", "message", "seq", "kind", "role", F.coalesce("text", F.lit("")).alias("text")).repartition("conv_id")
    messages = events.groupBy("conv_id", "message").agg(
        F.max(at(OPEN)).alias("opened"),
        F.max_by(F.struct("turn", "role"), at(OPEN)).alias("head"),
        F.max(at(OPEN, EDIT, REGENERATE)).alias("base"),
        F.max(at(REGENERATE)).alias("again"),
        F.collect_set(F.struct("seq", "text")).alias("events"),
    ).where("opened IS NOT NULL")
    said = F.filter(F.sort_array("events"), lambda e: e["seq"] >= F.col("base"))
    texts = messages.select(
        "conv_id", F.col("head.turn").alias("turn"), "message", "opened", "again",
        F.coalesce("head.role", F.lit("")).alias("role"), F.array_join(F.transform(said, lambda e: e["text"]), "").alias("text"))
    before = Window.partitionBy("conv_id").orderBy("turn", "message").rowsBetween(Window.unboundedPreceding, -1)
    swept = texts.withColumn("swept", F.max("again").over(before))
    return swept.where("swept IS NULL OR swept <= opened").select("conv_id", "turn", "message", "role", "text")


def render(messages: DataFrame, template: Template = Template()) -> DataFrame:
    """(conv_id, n_turns, segments): the formatted conversation is the segments' texts one
    after the other; ``loss`` marks those that are trained on."""
    turns = messages.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "message", "role", "text"))).alias("turns"))
    begin = F.array(F.struct(F.lit(template.begin).alias("text"), F.lit(False).alias("loss")))
    segments = F.concat(begin, F.flatten(F.transform("turns", template.segments)))
    return turns.select("conv_id", F.size("turns").cast("long").alias("n_turns"), segments.alias("segments"))


def formatted(segments: str = "segments") -> Column:
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def loss_text(template: Template = Template(), segments: str = "segments") -> Column:
    """What the loss mask covers, unescaped: the texts under it one after the other."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: template.unescape(s["text"])), "")


def as_log(rows: DataFrame, piece: int = 256) -> DataFrame:
    """The event log of a table of whole messages (conv_id, turn, role, text), as a chat service
    would have streamed it: each message opens and its text arrives in deltas of ``piece`` code
    points.  By a hash of the message, a quarter of the assistant's were first streamed
    otherwise, had an answer, and were generated again; a quarter of the others were edited.
    Folded, the log gives the rows back; rows on one turn stand in the order of role and a
    hash of the text."""
    text = F.coalesce("text", F.lit(""))
    dice = F.pmod(F.xxhash64("conv_id", "turn", "role"), F.lit(4))
    own = rows.select("conv_id", "turn", "role", text.alias("text"), dice.alias("dice"),
                      F.struct("role", F.xxhash64(text).alias("hash"), F.monotonically_increasing_id().alias("copy")).alias("message"))
    copy = F.col("message.copy")
    aside = F.struct(F.col("role").alias("role"), F.col("message.hash").alias("hash"), (-1 - copy).alias("copy"))

    def event(step, kind: str, said, message=F.col("message"), turn=F.col("turn"), role=F.lit(None).cast("string")):
        seq = F.struct(F.col("turn").alias("turn"), F.col("message").alias("message"), step.alias("step"))
        return F.struct(turn.alias("turn"), message.alias("message"), seq.alias("seq"), F.lit(kind).alias("kind"),
                        role.alias("role"), said.alias("text"))

    first = F.substr("text", F.lit(1), F.lit(piece))
    count = F.greatest(F.ceil(F.length("text") / piece), F.lit(1)).cast("long")
    # steps: 0 opens, 1 to 4 say something else first, then the pieces
    draft = event(F.lit(1).cast("long"), DELTA, F.reverse(first))
    answer = event(F.lit(2).cast("long"), OPEN, F.lit("go on"), aside, F.col("turn") + 1, F.lit("user"))
    again = event(F.lit(3).cast("long"), REGENERATE, first)
    edited = event(F.lit(3).cast("long"), EDIT, first)
    streamed = event(F.lit(3).cast("long"), DELTA, first)
    rest = F.transform(F.sequence(F.lit(2).cast("long"), count), lambda k: event(
        k + 3, DELTA, F.substr("text", ((k - 1) * piece + 1).cast("int"), F.lit(piece))))
    start = F.when((F.col("dice") == 0) & (F.col("role") == "assistant") & F.col("turn").isNotNull(), F.array(draft, answer, again)) \
        .when((F.col("dice") == 1) & (F.col("role") != "assistant"), F.array(draft, edited)).otherwise(F.array(streamed))
    opened = F.array(event(F.lit(0).cast("long"), OPEN, F.lit(None).cast("string"), role=F.col("role")))
    return own.select("conv_id", F.inline(F.concat(opened, start, F.when(count > 1, rest).otherwise(F.array().cast(
        own.select(F.array(streamed).alias("x")).schema["x"].dataType)))))


def digests(conversations: DataFrame, template: Template = Template()) -> DataFrame:
    """The digest columns of the driver query, read back from the rendered conversations."""
    done = render(fold(as_log(conversations)), template).select("conv_id", "segments", formatted().alias("formatted"))
    turns = template.turns(F.col("formatted"))
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    read = done.select("conv_id", "formatted", turns.alias("turns"), loss_text(template).alias("loss"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), sha(said).alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"), sha(F.col("loss")).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))
