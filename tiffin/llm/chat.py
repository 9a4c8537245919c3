r"""Chat formatting by incremental black-box rendering.

A template is any function from a list of (role, text) to a string; nothing is known of its inside.
The operator renders each prefix of a conversation. Where an output starts with the one before it,
the rest is the span of the new turn; where it does not, the template rewrites history, and the
conversation is marked and gets no spans. Where a turn's text lies in its span is seen by rendering
the turn with two different probe texts: the common start of both is the text's beginning, the
common end what follows it.

Comparison costs one rendering per turn, so a conversation of n turns costs about n / 2 times its
length; spans and texts of one conversation fit in one row, as the formatted conversation itself.

Turns are ordered by turn, then role and text; repeated rows are turns like any other. NULL text is
empty; a NULL role is the empty role. Rows without a conv_id make up one conversation.

The template of this library writes ``### role: text</turn>`` lines. In roles and texts a backslash
stands before each ``\``, ``#`` and ``<`` (in roles also ``:``), so neither marker can occur inside,
and reading back is exact.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiffin.llm.common import add_columns

Turns = list[tuple[str, str]]
END = "</turn>\n"
ESCAPE, ESCAPE_ROLE = re.compile(r"([\\#<])"), re.compile(r"([\\#<:])")
UNESCAPE = re.compile(r"\\(.)", re.S)
TURN = re.compile(r"### ((?:[^\\:#<]|\\.)*): ((?:[^\\#<]|\\.)*)</turn>\n", re.S)


def render(turns: Turns) -> str:
    return "".join(f"### {ESCAPE_ROLE.sub(r'\\\1', role)}: {ESCAPE.sub(r'\\\1', text)}{END}"
                   for role, text in turns)


def unescape(text: str) -> str:
    return UNESCAPE.sub(r"\1", text)


def parse(output: str) -> Turns:
    """Turns of a formatted text; an error if anything else is in it."""
    out, at = [], 0
    while at < len(output):
        m = TURN.match(output, at)
        if m is None:
            raise ValueError(f"no turn at {at}")
        out.append((unescape(m.group(1)), unescape(m.group(2))))
        at = m.end()
    return out


def _common(a: str, b: str) -> int:
    """Length of the common start, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def locate(turns: Turns, template: Callable[[Turns], str]
           ) -> tuple[str, list[tuple[int, int, int, int]], int]:
    """Output, (start, end, text start, text end) of each turn, and the first turn whose addition
    rewrites what stood before (-1: none)."""
    spans: list[tuple[int, int, int, int]] = []
    before = template([])
    for k, (role, _) in enumerate(turns):
        now = template(turns[:k + 1])
        if not now.startswith(before):
            return template(turns), [], k
        x, y = (template([*turns[:k], (role, probe)]) for probe in ("a", "b"))
        start = _common(x, y)
        after = _common(x[:start - 1:-1] if start else x[::-1],
                        y[:start - 1:-1] if start else y[::-1])
        spans.append((len(before), len(now), start, len(now) - after))
        before = now
    return before, spans, -1


TURN_SPAN = T.StructType([T.StructField("role", T.StringType())] + [
    T.StructField(n, T.LongType()) for n in ("start", "end", "text_start", "text_end")])


def gather(conversations: DataFrame) -> DataFrame:
    """One row per conversation: turns in order."""
    turn = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"),
                    F.coalesce("text", F.lit("")).alias("text"))
    return conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))


def format_chats(gathered: DataFrame, template: Callable[[Turns], str] = render) -> DataFrame:
    """Add formatted, spans and rewrites (place of the first turn that rewrites history, or -1)."""
    kind = pa.list_(pa.struct([("role", pa.string())] + [
        (n, pa.int64()) for n in ("start", "end", "text_start", "text_end")]))

    def make():
        def fn(rows: list) -> list[pa.Array]:
            out = []
            for turns in rows:
                pairs = [(t["role"], t["text"]) for t in turns or ()]
                text, spans, rewrites = locate(pairs, template)
                out.append((text, [dict(zip(("role", "start", "end", "text_start", "text_end"),
                                            (p[0], *s), strict=True))
                                   for p, s in zip(pairs, spans, strict=False)], rewrites))
            return [pa.array([o[0] for o in out], pa.string()),
                    pa.array([o[1] for o in out], kind),
                    pa.array([o[2] for o in out], pa.int64())]
        return fn
    return add_columns(gathered, "turns", [
        T.StructField("formatted", T.StringType()), T.StructField("spans", T.ArrayType(TURN_SPAN)),
        T.StructField("rewrites", T.LongType())], make)


def read_back(formatted: DataFrame) -> DataFrame:
    """Add read (role, text per turn, parsed from the output) and loss_text (the assistant texts
    under the loss mask, unescaped)."""
    pair = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))

    def make():
        def fn(rows: list) -> list[pa.Array]:
            read, loss = [], []
            for row in rows:
                text = row["formatted"] or ""
                read.append([{"role": r, "text": t} for r, t in parse(text)])
                loss.append("".join(unescape(text[s["text_start"]:s["text_end"]])
                                    for s in row["spans"] if s["role"] == "assistant"))
            return [pa.array(read, pair), pa.array(loss, pa.string())]
        return fn
    both = formatted.withColumn("output", F.struct("formatted", "spans"))
    turn = T.StructType([T.StructField("role", T.StringType()),
                         T.StructField("text", T.StringType())])
    return add_columns(both, "output", [T.StructField("read", T.ArrayType(turn)),
                                        T.StructField("loss_text", T.StringType())], make)


def digests(conversations: DataFrame, template: Callable[[Turns], str] = render) -> DataFrame:
    """Per conversation the counts and digests of what is read back from the output."""
    rows = read_back(format_chats(gather(conversations.select("conv_id", "turn", "role", "text")),
                                  template))
    turns = F.array_join(F.transform("read", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return rows.select(
        "conv_id", F.size("read").cast("long").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
