r"""Conversations with typed content parts as text for training, and back.

A turn is a list of parts: text, images, audio, documents. A visitor goes through them in order: text is escaped, each
attachment becomes a placeholder, and its reference, place and the tokens that it will expand to are recorded. Turns
are marked by role:

    [INST]text[/INST]                       user
    <s>text</s>                             assistant; the text bears loss
    [ROLE]role[/ROLE]text[END]              any other role, also none
    [IMG]  [AUD]  [DOC]                     placeholders

A control string within a text gets a backslash behind its first character, as does one that has some there already:
``[INST]`` becomes ``[\INST]``, ``[\INST]`` becomes ``[\\INST]``. Taking one away restores the text, whatever it holds.
Everything is made of DataFrame functions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

# --- fixed values: the template's control strings ---------------------------------------------
USER, USER_END = "[INST]", "[/INST]"
ASSISTANT, ASSISTANT_END = "<s>", "</s>"
ROLE, ROLE_END, END = "[ROLE]", "[/ROLE]", "[END]"
PLACEHOLDERS = {"image": "[IMG]", "audio": "[AUD]", "document": "[DOC]"}

#: What follows the first character of a control string.
_REST = r"/?s>|/?INST\]|/?ROLE\]|END\]|IMG\]|AUD\]|DOC\]"
_PLACEHOLDER = r"\[(?:IMG|AUD|DOC)\]"
_TURN = r"(?s)\[INST\].*?\[/INST\]|<s>.*?</s>|\[ROLE\].*?\[/ROLE\].*?\[END\]"

PART = "struct<kind: string, text: string, ref: string, width: int, height: int, seconds: double, pages: int>"


@dataclass(frozen=True)
class Expansion:
    """Tokens that a placeholder stands for: an image has one for each square of ``patch`` points, audio so many a
    second, a document so many a page. A size that isn't known counts as one square, second or page."""

    patch: int = 28
    audio_per_second: float = 25.0
    document_per_page: int = 512


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*)({_REST})", r"$1$2\\$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*)({_REST})", r"$1$2$3")


def text_part(text: Column) -> Column:
    """A part that holds a text."""
    return F.struct(F.lit("text").alias("kind"), text.alias("text"), *[
        F.lit(None).alias(c) for c in ("ref", "width", "height", "seconds", "pages")]).cast(PART)


def _is_attachment(part: Column) -> Column:
    return F.coalesce(part["kind"].isin(*PLACEHOLDERS), F.lit(False))


def _flat(parts: Column) -> Column:
    """The parts as text of the template. Neighbouring texts are joined before they are escaped, as a control string may
    begin in one and end in the next. Parts of unknown kind count by their text, null ones are empty."""
    marks = F.create_map(*[F.lit(x) for pair in PLACEHOLDERS.items() for x in pair])
    shown = F.transform(F.filter(parts, _is_attachment), lambda p: marks[p["kind"]])
    places = F.filter(F.transform(parts, lambda p, k: F.when(_is_attachment(p), k + 1)), lambda k: k.isNotNull())
    bounds = F.concat(F.array(F.lit(0)), places, F.array(F.size(parts) + 1))

    def between(k: Column) -> Column:
        first = F.get(bounds, k) + 1
        some = F.slice(parts, first, F.get(bounds, k + 1) - first)
        return F.array_join(F.transform(some, lambda p: F.coalesce(p["text"], F.lit(""))), "")

    texts = F.transform(F.sequence(F.lit(0), F.size(places)), between)
    return F.array_join(F.zip_with(texts, shown, lambda t, m: F.concat(escaped(t), F.coalesce(m, F.lit("")))), "")


def _tokens(part: Column, expansion: Expansion) -> Column:
    def squares(side: str) -> Column:
        return F.greatest(F.lit(1), F.ceil(F.coalesce(part[side], F.lit(1)) / expansion.patch))

    seconds, pages = F.coalesce(part["seconds"], F.lit(1.0)), F.coalesce(part["pages"], F.lit(1))
    return (F.when(part["kind"] == "image", squares("width") * squares("height"))
            .when(part["kind"] == "audio", F.greatest(F.lit(1), F.ceil(seconds * expansion.audio_per_second)))
            .otherwise(F.greatest(F.lit(1), pages * expansion.document_per_page)).cast("long"))


def format_turns(rows: DataFrame, expansion: Expansion = Expansion()) -> DataFrame:
    """Rows (``conv_id``, ``own``, ``place``, ``start``, ``piece``, ``loss_first``, ``loss_length``, ``attachments``): each turn as text.

    ``rows`` have ``conv_id``, ``turn``, ``role`` and ``parts`` (an array of :data:`PART`); null parts are none. ``place``
    counts a conversation's turns from 0, by turn, then role and text, nulls first. ``start`` is the code point at which
    the piece begins in the conversation; ``loss_first`` and ``loss_length`` tell which of its own bear loss (none: 0, 0).
    ``attachments`` hold kind, reference, the placeholder's number within the turn and the tokens it expands to.

    A row without ``conv_id`` is a conversation of its own (``own`` tells them apart; it's 0 for all others).
    """
    parts = F.coalesce("parts", F.array().cast(f"array<{PART}>"))
    own = F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id() + 1).otherwise(F.lit(0)).alias("own")
    body = _flat(parts)
    listed = F.filter(parts, _is_attachment)
    attachments = F.transform(listed, lambda p, k: F.struct(
        p["kind"].alias("kind"), p["ref"].alias("ref"), k.alias("number"), _tokens(p, expansion).alias("tokens")))
    turns = rows.select("conv_id", own, "turn", F.coalesce("role", F.lit("")).alias("role"), body.alias("body"),
                        attachments.alias("attachments"))
    role, body = F.col("role"), F.col("body")
    piece = (F.when(role == "user", F.concat(F.lit(USER), body, F.lit(USER_END)))
             .when(role == "assistant", F.concat(F.lit(ASSISTANT), body, F.lit(ASSISTANT_END)))
             .otherwise(F.concat(F.lit(ROLE), escaped(role), F.lit(ROLE_END), body, F.lit(END))))
    bears = role == "assistant"
    turns = turns.select("conv_id", "own", "turn", "role", "attachments", piece.alias("piece"),
                         F.when(bears, len(ASSISTANT)).otherwise(0).cast("long").alias("loss_first"),
                         F.when(bears, F.length("body")).otherwise(0).cast("long").alias("loss_length"))
    within = Window.partitionBy("conv_id", "own").orderBy("turn", "role", "piece")
    before = F.sum(F.length("piece").cast("long")).over(within.rowsBetween(Window.unboundedPreceding, -1))
    return turns.select("conv_id", "own", (F.row_number().over(within) - 1).alias("place"),
                        F.coalesce(before, F.lit(0)).alias("start"), "piece", "loss_first", "loss_length", "attachments")


def format_conversations(rows: DataFrame, expansion: Expansion = Expansion()) -> DataFrame:
    """Rows (``conv_id``, ``formatted``, ``spans``, ``attachments``, ``expanded_tokens``), one for each conversation.

    ``spans`` has for each turn its first code point in ``formatted``, its length, and the code points within it that
    bear loss: the escaped texts of assistant turns. ``attachments`` are those of all turns in order, each with its
    ``turn``; ``expanded_tokens`` sums the tokens that they expand to. A conversation is one value, so it has to
    fit into memory, as long as it may be; texts and turns have no limit else. An empty table gives no rows, other columns
    are ignored.
    """
    turns = format_turns(rows, expansion)
    each = F.struct("place", "start", "piece", "loss_first", "loss_length", "attachments")
    # partitioned as the window is, so conversations are shuffled once
    gathered = turns.groupBy("conv_id", "own").agg(F.array_sort(F.collect_list(each)).alias("turns"))
    found = F.flatten(F.transform("turns", lambda t: F.transform(t["attachments"], lambda a: F.struct(
        t["place"].alias("turn"), a["kind"].alias("kind"), a["ref"].alias("ref"), a["number"].alias("number"),
        a["tokens"].alias("tokens")))))
    spans = F.transform("turns", lambda t: F.struct(
        t["start"].alias("start"), F.length(t["piece"]).cast("long").alias("length"), t["loss_first"].alias("loss_first"),
        t["loss_length"].alias("loss_length")))
    return gathered.select("conv_id", F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
                           spans.alias("spans"), found.alias("attachments")).withColumn(
        "expanded_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda a, x: a + x["tokens"]))


def _inside(piece: Column, begin: Column, finish: str) -> Column:
    """The text between the first ``begin`` code points of a piece and its closing mark."""
    return F.substring(piece, begin + 1, F.length(piece) - begin - len(finish))


def _read_turn(piece: Column) -> Column:
    """Role, and body still escaped."""
    role = F.substring_index(F.substring(piece, F.lit(len(ROLE) + 1), F.length(piece)), ROLE_END, 1)
    head = F.lit(len(ROLE) + len(ROLE_END)) + F.length(role)
    is_user, is_assistant = F.startswith(piece, F.lit(USER)), F.startswith(piece, F.lit(ASSISTANT))
    body = (F.when(is_user, _inside(piece, F.lit(len(USER)), USER_END))
            .when(is_assistant, _inside(piece, F.lit(len(ASSISTANT)), ASSISTANT_END))
            .otherwise(_inside(piece, head, END)))
    return F.struct(F.when(is_user, F.lit("user")).when(is_assistant, F.lit("assistant")).otherwise(unescaped(role)).alias("role"),
                    body.alias("body"))


def read_back(formatted: DataFrame) -> DataFrame:
    """The given rows with ``turns`` and ``loss_text``, both read from ``formatted`` alone and its ``spans``.

    Each of ``turns`` has the role, the ``text`` without placeholders, the ``texts`` between them and their ``kinds``.
    ``loss_text`` is the text under the loss mask, unescaped. Text parts that were neighbours are one.
    """
    kind_of = F.create_map(*[F.lit(x) for kind, mark in PLACEHOLDERS.items() for x in (mark, kind)])
    pieces = F.regexp_extract_all("formatted", F.lit(_TURN), F.lit(0))
    texts = lambda body: F.transform(F.split(body, _PLACEHOLDER), unescaped)
    turns = F.transform(F.transform("pieces", _read_turn), lambda t: F.struct(
        t["role"].alias("role"), F.array_join(texts(t["body"]), "").alias("text"), texts(t["body"]).alias("texts"),
        F.transform(F.regexp_extract_all(t["body"], F.lit(_PLACEHOLDER), F.lit(0)), lambda m: kind_of[m]).alias("kinds")))
    masked = F.zip_with("pieces", "spans", lambda p, s: F.substring(
        p, (s["loss_first"] + 1).cast("int"), s["loss_length"].cast("int")))
    plain = F.transform(masked, lambda x: F.array_join(texts(x), ""))
    return formatted.select("*", pieces.alias("pieces")).select(
        *formatted.columns, turns.alias("turns"), F.array_join(plain, "").alias("loss_text"))
