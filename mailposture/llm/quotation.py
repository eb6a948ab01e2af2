"""Chat formatting: quotation linking.

A line's quote level is the number of > signs it begins with. A quoted passage is a run of lines of one level; it is
normalised (signs off, case folded, blanks and line ends made one space, so that re-wrapping does not matter) and
hashed. So are its paragraphs and its lines, in case that a passage was cut. Own words of all messages are hashed alike:
the whole, its paragraphs, its lines. A passage is joined to the latest earlier message of its conversation that has it
as its own; only where there is none its paragraphs are, and only where a paragraph has none its lines. A message
replies to the message that most lines of its least nested quotes come from (the later one of equals).

Replies form trees, and ``thread_root`` and ``depth`` order each conversation so that a message stands behind what it
replies to; messages that quote nothing are roots. Clean text is the own lines without the line that announces a quote.
``assemble`` puts the clean turns of a conversation together in reply order: thread by thread, and within a thread by
turn; conversations of more than PART turns come in several parts, numbered in that order.

The latest earlier message is found in two steps, so that a passage that is very common in a very long conversation is
not gathered in one task: the latest turn within a range of turns, then the latest range before it. Roots are found
by pointer doubling in a number of rounds that is the logarithm of the longest chain; the replies to a message that very
many reply to stay where they are.

Null texts have no lines and stay null. Messages without conversation or turn are kept as roots without links and
belong to no assembled conversation. A turn that occurs several times in a conversation counts as one message for
linking; all its rows are kept and get the same place, and the one with the least hash is assembled. Empty tables give
no rows. Other columns are kept; the new names must not exist yet, or be given a prefix.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType

from mailposture.llm.common import cut, hot_join, hot_left_join
from mailposture.operators.tables import running, short

#: Turns of one range in the two-step search for the latest earlier message, and of one part of a conversation.
RANGE, PART = 64, 1024
#: Conversations with quotes up to which their list is broadcast.
QUOTING = 100_000

#: A line that announces a quote.
ANNOUNCES = re.compile(r"(on|am|le|el)\b.*\b(wrote|schrieb|écrit|escribió)\b.*:\s*", re.I)
_MARKS = re.compile(r"\s*((?:>\s?)+)", re.A)
_BLANKS = re.compile(r"\s+", re.A)

LINE, PARAGRAPH, PASSAGE = 1, 2, 3


def marked(text: str) -> list[tuple[int, str]]:
    """(quote level, line without its signs) of each line."""
    out = []
    for line in text.split("\n"):
        m = _MARKS.match(line) if ">" in line else None
        out.append((m.group(1).count(">"), line[m.end() :]) if m else (0, line))
    return out


def normal(lines: list[str]) -> str:
    """Lines joined by a space, without case and surplus blanks."""
    return _BLANKS.sub(" ", " ".join(lines).lower()).strip(" ")


def units(lines: list[tuple[int, str]]) -> Iterator[tuple[int, int, int, int, str, int]]:
    """(level, passage, paragraph, size, normal text, lines) of what may be quoted and what is quoted.

    Of quoted lines, in order: passages are runs of one level, paragraphs runs between blank lines of a passage. Own
    lines make one passage, whatever stands between them, and paragraphs between blank or quoted lines.
    """
    passages: list[list[list[str]]] = []
    levels, own, before = [], None, None
    for level, line in lines:
        if level == 0:
            if own is None:
                own = len(passages)
                passages.append([[]])
                levels.append(0)
            at = own
            if before:
                passages[at].append([])
        elif level != before:
            at = len(passages)
            passages.append([[]])
            levels.append(level)
        before = level
        if line and not _BLANKS.fullmatch(line):
            passages[at][-1].append(line)
        elif passages[at][-1]:
            passages[at].append([])
    for k, (level, paragraphs) in enumerate(zip(levels, passages, strict=True)):
        paragraphs = [p for p in paragraphs if p]
        if paragraphs:
            yield level, k, -1, PASSAGE, normal(sum(paragraphs, [])), sum(map(len, paragraphs))
        for j, p in enumerate(paragraphs):
            yield level, k, j, PARAGRAPH, normal(p), len(p)
            for line in p:
                yield level, k, j, LINE, normal([line]), 1


def hashed_units(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", text: str = "text") -> DataFrame:
    """(conv, turn, m, level, passage, paragraph, size, h, n) of the messages; own words come once for each hash.

    m tells messages of one turn apart.
    """
    known = messages.filter(F.col(conv).isNotNull() & F.col(turn).isNotNull() & F.col(text).isNotNull())
    known = known.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.col(text).alias("text"))
    # Conversations without any quoted line need no cutting up, if a list of the others is short enough to say so.
    quoting = cut(known.filter(F.contains("text", F.lit(">")) & F.col("text").rlike(r"(?m)^\s*>")).select("conv").distinct())
    if quoting.count() <= QUOTING:
        known = known.join(F.broadcast(quoting), "conv", "left_semi")
    known = known.select("conv", "turn", F.xxhash64("text").alias("m"), "text")
    names = ["conv", "turn", "m", "level", "passage", "paragraph", "size", "h", "n"]

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, rows = [], []
            for i, t in enumerate(batch.column(3)):
                found: dict[tuple, int] = {}
                for level, passage, paragraph, size, words, n in units(marked(t.as_py())):
                    h = xxhash.xxh64_intdigest(words.encode("utf-8", "surrogatepass"))
                    key = (level, passage, paragraph, size, h) if level else (0, -1, -1, 0, h)
                    found[key] = found.get(key, 0) + n
                at += [i] * len(found)
                rows += [(*k, n) for k, n in found.items()]
            columns = list(zip(*rows, strict=True)) or [()] * 6
            kinds = [pa.int32()] * 4 + [pa.uint64(), pa.int64()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            arrays[4] = arrays[4].view(pa.int64())
            where = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([*(c.take(where) for c in batch.columns[:3]), *arrays], names)

    schema = known.drop("text").schema
    for name in names[3:7]:
        schema = type(schema)([*schema.fields]).add(name, IntegerType())
    return known.mapInArrow(cut_up, type(schema)([*schema.fields]).add("h", LongType()).add("n", LongType()))


def sources(quoted: DataFrame, own: DataFrame) -> DataFrame:
    """(conv, h, turn, source): the latest earlier turn with the words as its own, for each (conv, h, turn) quoted."""
    here = F.floor(F.col("turn") / RANGE).alias("r")
    own = own.select("conv", "h", "turn", here).distinct()
    asked = own.groupBy("conv", "h").agg(F.count("*").alias("_n")).join(quoted.select("conv", "h").distinct(), ["conv", "h"])
    own = cut(hot_join(own, asked, ["conv", "h"], own.count()))
    both = quoted.select("conv", "h", "turn", here, F.lit(None).cast("long").alias("own")).distinct().unionByName(own.select("conv", "h", "turn", "r", F.col("turn").cast("long").alias("own")))
    # Latest own turn before each quote within its range: RANGE turns at most share such a window.
    within = Window.partitionBy("conv", "h", "r").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    both = both.withColumn("near", F.max("own").over(within)).filter("own is null")
    # Latest own turn of the ranges before: one row a range.
    last = own.groupBy("conv", "h", "r").agg(F.max("turn").alias("last"))
    ranges = both.select("conv", "h", "r").distinct().join(last, ["conv", "h", "r"], "full")
    before = Window.partitionBy("conv", "h").orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    far = ranges.withColumn("far", F.max("last").over(before)).select("conv", "h", "r", "far")
    found = both.join(far, ["conv", "h", "r"], "left").withColumn("source", F.coalesce("near", "far"))
    return found.filter("source is not null").select("conv", "h", "turn", "source")


def links(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", text: str = "text") -> DataFrame:
    """(conv, turn, level, source, lines): how many lines of a quote level come from which earlier turn."""
    cut_up = cut(hashed_units(messages, conv, turn, text))
    quoted, own = cut_up.filter("level > 0"), cut_up.filter("level = 0")
    quoted = quoted.distinct()  # repeated messages count once
    found = quoted.join(sources(quoted, own), ["conv", "h", "turn"])
    # The largest unit that has a source stands for what it holds.
    whole = Window.partitionBy("conv", "turn", "m", "passage")
    part = Window.partitionBy("conv", "turn", "m", "passage", "paragraph")
    best = found.withColumns({"_whole": F.max("size").over(whole), "_part": F.max("size").over(part)})
    best = best.filter(F.when(F.col("_whole") == PASSAGE, F.col("size") == PASSAGE).otherwise(F.col("size") == F.col("_part")))
    return best.groupBy("conv", "turn", "level", "source").agg(F.sum("n").alias("lines"))


def parents(found: DataFrame) -> DataFrame:
    """(conv, turn, reply_to): the source of most lines of the least level that has any; the later one of equals."""
    best = F.max(F.struct(-F.col("level"), "lines", "source"))
    return found.groupBy("conv", "turn").agg(best["source"].alias("reply_to"))


def roots(replies: DataFrame) -> DataFrame:
    """(conv, turn, reply_to, thread_root, depth) of the messages that reply: pointers double each round."""
    up = cut(replies.select("conv", "turn", "reply_to", F.col("reply_to").alias("thread_root"), F.lit(1).cast("long").alias("depth")))
    rows = up.count()
    while rows:
        above = up.select("conv", F.col("turn").alias("thread_root"), F.col("thread_root").alias("higher"), F.col("depth").alias("more"))
        asked = up.groupBy("conv", "thread_root").agg(F.count("*").alias("_n")).join(above, ["conv", "thread_root"], "left")
        joined = hot_join(up, asked, ["conv", "thread_root"], rows)
        depth = (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")
        after = cut(joined.select("conv", "turn", "reply_to", F.coalesce("higher", "thread_root").alias("thread_root"), depth, F.col("higher").isNotNull().alias("rose")))
        up = after.drop("rose")
        if after.filter("rose").isEmpty():
            break
    return up


def cleaned(lines: list[tuple[int, str]], text: str) -> tuple[int, str]:
    """(number of quoted lines, own lines without the line that announces a quote) of a message."""
    quoted = sum(level > 0 for level, _ in lines)
    if not quoted:
        return 0, text
    below = [level for level, _ in lines[1:]] + [0]
    own = [line for (level, line), after in zip(lines, below, strict=True) if not level and not (after and ANNOUNCES.fullmatch(line))]
    return quoted, "\n".join(own).strip(" ")


def conversations(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", prefix: str = "") -> DataFrame:
    """Add reply_to, thread_root, depth, quoted_lines, clean_text and chat (role-tagged clean text).

    (conv, thread_root, turn) is the reply order. Messages whose clean text is empty keep an empty chat turn. ``prefix``
    goes before the new names.
    """
    names = [f"{prefix}{x}" for x in ("reply_to", "thread_root", "depth", "quoted_lines", "clean_text", "chat")]
    if clash := {*names, "_c", "_t", "_reply", "_root", "_depth"} & set(messages.columns):
        raise ValueError(f"columns exist already, give a prefix: {sorted(clash)}")
    at = messages.columns.index(text)

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = [(0, None) if t is None else cleaned(marked(t), t) for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([q for q, _ in both], pa.int64()), pa.array([c for _, c in both], pa.string())], [*batch.schema.names, names[3], names[4]])

    schema = type(messages.schema)([*messages.schema.fields]).add(names[3], LongType()).add(names[4], StringType())
    there = F.col(conv).isNotNull() & F.col(turn).isNotNull()
    placed = roots(parents(links(messages, conv, turn, text)))
    kind = placed.schema["reply_to"].dataType
    placed = placed.select(F.col("conv").alias("_c"), F.col("turn").alias("_t"), F.col("reply_to").alias("_reply"), F.col("thread_root").alias("_root"), F.col("depth").alias("_depth"))
    known = messages.filter(there).mapInArrow(tidied, schema).withColumns({"_c": F.col(conv), "_t": F.col(turn)})
    lone = messages.filter(~there).mapInArrow(tidied, schema)
    keys = messages.filter(there).select(F.col(conv).alias("_c"), F.col(turn).alias("_t"))
    out = hot_left_join(known, placed, ["_c", "_t"], keys, messages.count()).drop("_c", "_t")
    out = out.unionByName(lone.withColumns({"_reply": F.lit(None).cast(kind), "_root": F.lit(None).cast(kind), "_depth": F.lit(None).cast("long")}))
    tagged = F.concat(F.lit("<|"), F.coalesce(F.col(role).cast("string"), F.lit("unknown")), F.lit("|>\n"), F.coalesce(names[4], F.lit("")), F.lit("\n<|end|>"))
    root, depth = F.coalesce("_root", F.col(turn)), F.coalesce("_depth", F.lit(0).cast("long"))
    return out.select(*messages.columns, F.col("_reply").alias(names[0]), root.alias(names[1]), depth.alias(names[2]), names[3], names[4], tagged.alias(names[5]))


def repeats(messages: DataFrame, conv: str = "conv_id", turn: str = "turn") -> bool:
    """Whether a turn of a conversation occurs more than once."""
    keys = messages.filter(F.col(conv).isNotNull() & F.col(turn).isNotNull()).groupBy(conv, turn).count()
    return not keys.filter("count > 1").isEmpty()


def assemble(placed: DataFrame, conv: str = "conv_id", turn: str = "turn", root: str = "thread_root", chat: str = "chat", part: int = PART, repeated: bool = True) -> DataFrame:
    """(conv, part, first_turn, messages, conversation) of the messages that ``conversations`` placed.

    A conversation's messages are numbered in reply order, thread by thread and by turn within a thread; part k holds
    the numbers from k * ``part`` up to the next one's, so that parts in their order are the conversation in reply
    order. ``repeated`` false (see ``repeats``) saves a shuffle of the texts.
    """
    known = placed.filter(F.col(conv).isNotNull() & F.col(turn).isNotNull())
    rows = known.select(conv, turn, F.col(root).alias("_root"), F.col(chat).alias("_chat"))
    if repeated:
        # Of a repeated turn the row with the least hash counts; rows are combined where they are first.
        one = rows.groupBy(conv, turn).agg(F.min(F.struct(F.xxhash64("_chat"), "_root", "_chat")).alias("_m"))
        rows = one.select(conv, turn, "_m._root", "_m._chat")
    # Numbers of long conversations are counted range by range; all messages of the others have part 0.
    places = cut(known.select(conv, turn, F.col(root).alias("_root")).distinct())
    long = places.groupBy(conv).agg(F.count("*").alias("_n")).filter(F.col("_n") > part).select(conv)
    numbered = running(places.join(long, conv, "left_semi"), [F.col("_root").asc(), F.col(turn).asc()], {"_number": F.lit(1)}, [conv])
    parts = numbered.select(conv, turn, F.floor(F.col("_number") / part).alias("part"))
    rows = rows.join(short(parts), [conv, turn], "left").withColumn("part", F.coalesce("part", F.lit(0).cast("long")))
    m = F.struct(F.col("_root").alias("root"), F.col(turn).alias("turn"), F.col("_chat").alias("chat"))
    held = rows.groupBy(conv, "part").agg(F.array_sort(F.collect_list(m)).alias("m"))  # ``part`` at most
    return held.select(conv, "part", F.get("m", F.lit(0))["turn"].alias("first_turn"), F.size("m").cast("long").alias("messages"), F.array_join(F.col("m.chat"), "\n").alias("conversation"))
