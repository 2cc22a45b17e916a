"""Chat formatting by incremental black-box rendering (operator 5).

A template is any function from messages to text.  It is shown successive prefixes of a
conversation; what each output adds to the one before is the turn's span.  An output that
doesn't begin with the one before shows that the template rewrites history.  Where the text
stands inside a span is found by rendering two other texts in its place.
"""

import hashlib
import itertools
import re
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 64  # turns that an append-only template renders again once a conversation is twice as long

# The marks of the default template.
MARKS = {"system": ("[SYS] ", " [/SYS]"), "user": ("[INST] ", " [/INST]"), "assistant": ("[OUT] ", " [/OUT]</s>")}
START = "<s>"
TURN = re.compile(
    r"(?:<s>)?(?:\[SYS\] (?P<system>.*) \[/SYS\]|\[INST\] (?P<user>.*) \[/INST\]|\[OUT\] (?P<assistant>.*) \[/OUT\]</s>"
    r"|\[ROLE (?P<role>.*?(?<!\\)(?:\\\\)*)\] (?P<other>.*) \[/ROLE\])",
    re.DOTALL,
)


class Message(NamedTuple):
    role: str
    text: str


class Span(NamedTuple):
    role: str
    text: str | None  # the formatted turn; None once history was rewritten
    loss_from: int
    loss_to: int


def escape(text: str) -> str:
    """No mark can stand in the result: each begins with a bracket, and those get a backslash."""
    return re.sub(r"[\\\[\]<]", r"\\\g<0>", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def bracket_template(messages: list[Message]) -> str:
    """The default template; roles beyond the three are written out."""
    parts = [START] if messages else []
    for role, text in messages:
        before, after = MARKS.get(role) or (f"[ROLE {escape(role)}] ", " [/ROLE]")
        parts.append(before + escape(text) + after)
    return "".join(parts)


bracket_template.append_only = True


def read_turn(span: str) -> Message:
    """The role and text of a span of the default template."""
    found = TURN.fullmatch(span)
    if not found:
        raise ValueError(f"not a formatted turn: {span[:80]!r}")
    for role in MARKS:
        if found[role] is not None:
            return Message(role, unescape(found[role]))
    return Message(unescape(found["role"]), unescape(found["other"]))


def _same_start(a: str, b: str) -> int:
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[:mid] == b[:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def spans(messages: Iterable[Message], template: Callable = bracket_template, window: int = WINDOW) -> Iterator[Span]:
    """The span of each turn, as turns come in.

    A template sees every prefix from the start, so that a rewriting of any turn shows.  Only
    one with a true attribute ``append_only``, which says that what it adds for a turn depends
    on that turn alone, goes on from the last ``window`` turns once there are twice as many,
    if it renders those, without what came before, as it had rendered them.
    """
    held: list[Message] = []
    texts: list[str] = []
    base, sound, shift = "", True, getattr(template, "append_only", False)
    for message in messages:
        if shift and len(held) >= 2 * window:
            tail = template(held[-window:])
            if tail.endswith("".join(texts[1 - window :])):
                held, texts, base = held[-window:], texts[-window:], tail
            else:
                shift = False
        now = template([*held, message])
        sound = sound and now.startswith(base)
        if not sound:
            yield Span(message.role, None, 0, 0)
            continue
        span = now[len(base) :]
        one, two = (template([*held, Message(message.role, c)])[len(base) :] for c in "xy")
        start = _same_start(one, two)
        yield Span(message.role, span, start, len(span) - (len(one) - start - 1))
        held.append(message)
        texts.append(span)
        base = now


def _turns(batches) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text")))


def _conversations(batches) -> Iterator[tuple[int | None, Iterator[tuple]]]:
    """``(conv_id, its turns)``; turns are read as they are used."""
    return itertools.groupby(_turns(batches), key=lambda t: t[0])


def _in_order(turns: DataFrame) -> DataFrame:
    """Whole conversations in tasks; turns in order, ties by role and text."""
    rows = turns.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def format_turns(turns: DataFrame, template: Callable = bracket_template, window: int = WINDOW) -> DataFrame:
    """One row for each turn: ``conv_id, turn, n, role, span, loss_from, loss_to``.

    The spans of a conversation in the order of ``n`` are its formatted text.  Characters
    ``loss_from`` up to ``loss_to`` of an assistant's span are under the loss mask; both are
    0 for other roles.  From where a template rewrites history on, spans are null.  Defined
    cases: a null role or text is empty; null conv_ids are one conversation; repeated rows
    are turns of their own; a null turn comes first; other columns play no part.
    """

    def write(batches):
        for conv_id, some in _conversations(batches):
            seen: list[tuple] = []

            def read(some=some, seen=seen):
                for row in some:
                    seen.append(row)
                    yield Message(row[2], row[3])

            out = []
            for n, span in enumerate(spans(read(), template, window)):
                mask = (span.loss_from, span.loss_to) if span.role == "assistant" else (0, 0)
                out.append((conv_id, seen.pop()[1], n, span.role, span.text, *mask))
                if len(out) >= 500:
                    yield _batch(out)
                    out = []
            if out:
                yield _batch(out)

    shape = "conv_id long, turn long, n long, role string, span string, loss_from long, loss_to long"
    return _in_order(turns).mapInArrow(write, shape)


def _batch(rows) -> pa.RecordBatch:
    kinds = {"role": pa.string(), "span": pa.string()}
    names = ["conv_id", "turn", "n", "role", "span", "loss_from", "loss_to"]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds.get(n, pa.int64())) for n, c in zip(names, zip(*rows))], names)


def conversation_digests(turns: DataFrame, window: int = WINDOW) -> DataFrame:
    """Format with the default template, read the output back, and digest it by conversation.

    One row for each conv_id: ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars``.  Everything but conv_id is taken from the spans.  Hashes go on turn by
    turn, so a long conversation is never held as a whole.
    """
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def digest(batches):
        rows = []
        for conv_id, some in _conversations(batches):
            n = loss_chars = chars = 0
            all_, loss = hashlib.sha256(), hashlib.sha256()
            for span in spans((Message(r[2], r[3]) for r in some), bracket_template, window):
                role, text = read_turn(span.text)
                all_.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                if role == "assistant":
                    under = unescape(span.text[span.loss_from : span.loss_to])
                    loss.update(under.encode("utf-8", "surrogatepass"))
                    loss_chars += len(under)
                n, chars = n + 1, chars + len(span.text)
            rows.append((conv_id, n, all_.hexdigest(), loss_chars, loss.hexdigest(), chars))
            if len(rows) >= 2000:
                yield _digests(rows, names)
                rows = []
        if rows:
            yield _digests(rows, names)

    shape = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return _in_order(turns).mapInArrow(digest, shape)


def _digests(rows, names) -> pa.RecordBatch:
    text = {"turns_sha256", "loss_sha256"}
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.string() if n in text else pa.int64()) for n, c in zip(names, zip(*rows))], names
    )
