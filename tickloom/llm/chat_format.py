"""Chat formatting: typed content parts are flattened into one string a conversation, with a loss mask.

A message's content is an array of parts (type, text, ref, size). The visitor takes the parts in order: text is escaped
and copied, every other type becomes a numbered placeholder, its reference goes to the list of attachments and its size
is turned into the tokens that the placeholder will expand to. All of it is DataFrame functions.

A turn is written `<|role|>` body `</s>`, a conversation `<s>` turns. Inside roles and texts a backslash is put after the
first character of every control string and before every backslash, so that no control string is left and taking each
backslash's own backslash away gives the text back. Where a text part ends in what may be the beginning of a control string
and another text part follows, a backslash goes after that beginning's first character too.

Placeholders are numbered and spans placed by running sums over a conversation's parts, each part a row, so the work grows
with a conversation's length and no faster. A conversation is one value of the result, so its rows meet in one task by the
definition of the result; conversations are spread by a hash of their id.

Defined results: null text or content is empty, a null role is empty, turns go by turn number, then role and text, null
turn numbers first; repeated rows are repeated turns; rows with a null id form one conversation; an empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BEGIN, END = "<s>", "</s>"
#: Control strings that may not appear inside a text; the escape goes after their first character.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<|", "|>")
_ESCAPED = r"\\|<(?=/?s>|\|)|\[(?=/?INST\])|\|(?=>)"
#: What may be the beginning of a control string at a part's end.
_BEGUN = r"([<\[|])(/?(?:s|I|IN|INS|INST)?)\z"
#: Tokens for one unit of size: an image's 14 x 14 patch, a second of audio, a page of a document.
UNIT_TOKENS = {"image": 1.0, "audio": 25.0, "document": 1024.0}
#: Loss spans beyond which a string is cut into characters before they are taken out.
MANY_SPANS = 200
PARTS = "array<struct<type string, text string, ref string, size double>>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, r"$0\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def text_parts(text: Column) -> Column:
    """A plain text as content of one part."""
    none = F.lit(None)
    return F.array(F.struct(F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text"), none.cast("string").alias("ref"), none.cast("double").alias("size")))


def _is_text(part: Column) -> Column:
    return F.coalesce(part["type"], F.lit("text")) == "text"


def _tokens(part: Column) -> Column:
    """Tokens that an attachment expands to; an unknown type or size counts as one."""
    rate = F.lit(None).cast("double")
    for kind, per_unit in UNIT_TOKENS.items():
        rate = F.when(part["type"] == kind, per_unit).otherwise(rate)
    return F.greatest(F.lit(1), F.ceil(F.coalesce(part["size"] * rate, F.lit(1.0)))).cast("long")


def format_conversations(messages: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", content: Column | None = None, text_col: str = "text", loss_role: str = "assistant") -> DataFrame:
    """One row a conversation: conv_id, formatted, loss_spans, attachments, n_turns.

    loss_spans are (start, length) in code points of formatted, around the bodies of loss_role's turns. attachments are
    (number, type, ref, tokens) in order of their placeholders. content is an array of parts; else text_col is the content.
    """
    parts = F.coalesce(content, F.array().cast(PARTS)) if content is not None else text_parts(F.col(text_col))
    rows = messages.select(F.col(id_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), parts.alias("parts"))
    own = Window.partitionBy("conv_id")
    numbered = rows.withColumn("n", F.row_number().over(own.orderBy(F.col("turn").asc_nulls_first(), "role", "parts")))
    visited = numbered.select("conv_id", "n", "role", F.greatest(F.size("parts"), F.lit(1)).alias("n_parts"), F.posexplode_outer("parts").alias("pos", "part")).withColumn("pos", F.coalesce("pos", F.lit(0)))
    so_far = own.orderBy("n", "pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    part = F.col("part")
    goes_on = F.coalesce(F.lead(F.when(_is_text(part), F.col("n"))).over(own.orderBy("n", "pos")) == F.col("n"), F.lit(False))
    counted = visited.select("*", F.sum(F.when(_is_text(part), 0).otherwise(1)).over(so_far).alias("number"), goes_on.alias("goes_on"))
    text = escape(F.coalesce(part["text"], F.lit("")))
    text = F.when(F.col("goes_on"), F.regexp_replace(text, _BEGUN, r"$1\\$2")).otherwise(text)
    placeholder = F.concat(F.lit("<|"), escape(part["type"]), F.lit(":"), F.col("number").cast("string"), F.lit("|>"))
    shown = counted.select(
        "*",
        F.when(F.col("pos") == 0, F.concat(F.lit("<|"), escape(F.col("role")), F.lit("|>"))).otherwise("").alias("head"),
        F.when(_is_text(part), text).otherwise(placeholder).alias("body"),
        F.when(F.col("pos") == F.col("n_parts") - 1, END).otherwise("").alias("tail"),
    )
    length = lambda *names: sum((F.char_length(c).cast("long") for c in names[1:]), F.char_length(names[0]).cast("long"))
    placed = shown.select(
        "*",
        (len(BEGIN) + F.sum(length("head", "body", "tail")).over(so_far) - length("body", "tail")).alias("start"),
        F.sum(length("body")).over(Window.partitionBy("conv_id", "n")).alias("length"),
    )
    file = F.when(~_is_text(part), F.struct(F.col("number").cast("int").alias("number"), part["type"].alias("type"), part["ref"].alias("ref"), _tokens(part).alias("tokens")))
    span = F.when((F.col("pos") == 0) & (F.col("role") == loss_role), F.struct("start", "length"))
    whole = placed.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("n", "pos", F.concat("head", "body", "tail").alias("text")))).alias("texts"),
        F.sort_array(F.collect_list(span)).alias("loss_spans"),
        F.sort_array(F.collect_list(file)).alias("attachments"),
        F.max("n").cast("long").alias("n_turns"),
    )
    return whole.select("conv_id", F.concat(F.lit(BEGIN), F.array_join("texts.text", "")).alias("formatted"), "loss_spans", "attachments", "n_turns")


def read_back(formatted: DataFrame) -> DataFrame:
    """Roles and texts out of the formatted strings, and the text under the loss mask: conv_id, turns, loss_text, formatted.

    Taking a span out of a string counts its characters from the start, so a string with over MANY_SPANS spans is first cut
    into characters.
    """
    body = F.substring(F.col("formatted"), len(BEGIN) + 1, 2**31 - 1)
    pieces = F.filter(F.split(body, END), lambda p: p != "")
    turn = lambda p: F.struct(
        unescape(F.regexp_extract(p, r"(?s)^<\|(.*?)\|>(.*)$", 1)).alias("role"), unescape(F.regexp_extract(p, r"(?s)^<\|(.*?)\|>(.*)$", 2)).alias("text")
    )
    at = lambda s: ((s["start"] + 1).cast("int"), s["length"].cast("int"))
    few = F.transform("loss_spans", lambda s: F.col("formatted").substr(*at(s)))
    cut = formatted.withColumn("characters", F.when(F.size("loss_spans") > MANY_SPANS, F.split("formatted", "")))
    many = F.transform("loss_spans", lambda s: F.array_join(F.slice("characters", *at(s)), ""))
    masked = F.when(F.col("characters").isNotNull(), many).otherwise(few)
    return cut.select("conv_id", F.transform(pieces, turn).alias("turns"), F.array_join(F.transform(masked, unescape), "").alias("loss_text"), "formatted")


def digests(back: DataFrame) -> DataFrame:
    """The query's columns from what was read back."""
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.encode(said, "UTF-8"), 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.encode("loss_text", "UTF-8"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
