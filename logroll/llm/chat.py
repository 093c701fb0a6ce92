"""Chat formatting over typed content parts.  DataFrame functions only.

A turn is ``<|turn|>role\\nbody<|end|>\\n``.  A visitor walks the parts of every turn in order: text
is escaped; an image, audio or document part becomes the placeholder ``<|kind turn.part|>`` and an
entry of ``attachments`` (placeholder, kind, reference, expanded token count).  ``&``, ``<`` and
``[`` are escaped in texts and roles (line ends too in roles), so no text can form this template's
marks, ``</s>`` or ``[INST]``, and unescaping restores every text exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

TURN, END = "<|turn|>", "<|end|>\n"
PART = "struct<kind: string, text: string, ref: string, units: bigint>"
#: Tokens one unit of an attachment expands to (image tile, second of audio, document page).
RATES = {"image": 256, "audio": 25, "document": 512}


def escape(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
                     F.lit("["), F.lit("&lsqb;"))


def unescape(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("&lsqb;"), F.lit("[")), F.lit("&lt;"), F.lit("<")),
                     F.lit("&amp;"), F.lit("&"))


def _role(c: Column) -> Column:
    return F.replace(escape(F.coalesce(c, F.lit(""))), F.lit("\n"), F.lit("&nl;"))


def _unrole(c: Column) -> Column:
    return unescape(F.replace(c, F.lit("&nl;"), F.lit("\n")))


def text_part(c: Column) -> Column:
    return F.array(F.struct(F.lit("text").alias("kind"), F.coalesce(c, F.lit("")).alias("text"),
                            F.lit(None).cast("string").alias("ref"), F.lit(0).cast("bigint").alias("units")))


def _mark(part: Column, turn: Column, i: Column) -> Column:
    return F.concat(F.lit("<|"), part["kind"], F.lit(" "), turn.cast("string"), F.lit("."), i.cast("string"), F.lit("|>"))


def format_chats(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss, attachments) from (conv_id, turn, role, parts).

    ``loss``: spans (start, length) in code points of ``formatted`` that hold assistant texts.
    ``parts``: array of (kind, text, ref, units); null means no part; a null text is empty; an
    unknown kind is treated as a document.  Turns sort by turn (null first), then role and parts,
    so ties and repeated rows keep a fixed order; all are kept.  A null conv_id is a conversation.  Other
    columns are ignored.
    """
    known = F.transform(F.coalesce("parts", F.array().cast(f"array<{PART}>")), lambda p: F.struct(
        F.when(p["kind"].isin("text", *RATES), p["kind"]).otherwise("document").alias("kind"),
        F.coalesce(p["text"], F.lit("")).alias("text"), p["ref"].alias("ref"),
        F.coalesce(p["units"], F.lit(0)).alias("units")))
    said = turns.select("conv_id", F.struct(F.col("turn").cast("long").alias("turn"),
                                            F.coalesce("role", F.lit("")).alias("role"), known.alias("parts")).alias("t"))
    # Turns are numbered and placed by one ordered pass over the rows, so no array grows turn by turn.
    order = W.partitionBy("conv_id").orderBy("t")
    said = said.withColumn("j", F.row_number().over(order) - 1)

    def pieces(t, j):
        said = F.transform(t["parts"], lambda p, i: F.when(
            p["kind"] == "text", F.struct(escape(p["text"]).alias("s"), (t["role"] == "assistant").alias("loss")))
            .otherwise(F.struct(_mark(p, j, i).alias("s"), F.lit(False).alias("loss"))))
        head = F.concat(F.lit(TURN), _role(t["role"]), F.lit("\n"))
        plain = lambda c: F.array(F.struct(c.alias("s"), F.lit(False).alias("loss")))
        return F.concat(plain(head), said, plain(F.lit(END)))

    def expanded(p):
        rate = F.lit(RATES["document"])
        for kind in ("image", "audio"):
            rate = F.when(p["kind"] == kind, F.lit(RATES[kind])).otherwise(rate)
        return p["units"] * rate

    def attached(t, j):
        all_ = F.transform(t["parts"], lambda p, i: F.struct(
            _mark(p, j, i).alias("placeholder"), p["kind"].alias("kind"), p["ref"].alias("ref"),
            expanded(p).cast("bigint").alias("tokens")))
        return F.filter(all_, lambda a: a["kind"] != "text")

    t, j = F.col("t"), F.col("j")
    empty = F.array().cast("array<struct<start: bigint, length: bigint>>")
    inside = F.aggregate(
        "p", F.struct(F.lit(0).cast("bigint").alias("at"), empty.alias("spans")),
        lambda acc, x: F.struct(
            (acc["at"] + F.length(x["s"])).alias("at"),
            F.when(x["loss"], F.array_append(acc["spans"], F.struct(
                acc["at"].alias("start"), F.length(x["s"]).cast("bigint").alias("length"))))
            .otherwise(acc["spans"]).alias("spans")),
        lambda acc: acc["spans"])
    written = (said.select("conv_id", "t", "j", pieces(t, j).alias("p"), attached(t, j).alias("a"))
               .select("conv_id", "t", "j", "a", inside.alias("spans"), F.array_join(F.transform("p", lambda x: x["s"]), "").alias("s")))
    before = F.coalesce(F.sum(F.length("s")).over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    moved = F.transform("spans", lambda x: F.struct((x["start"] + F.col("at")).alias("start"), x["length"].alias("length")))
    placed = written.withColumn("at", before).select("conv_id", F.struct("j", "s", moved.alias("spans"), "a").alias("t"))
    whole = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return whole.select("conv_id", F.array_join("t.s", "").alias("formatted"), F.flatten("t.spans").alias("loss"),
                        F.flatten("t.a").alias("attachments"))


def read_back(chats: DataFrame) -> DataFrame:
    """(conv_id, formatted, turns (role, body), loss_text) parsed from the formatted strings."""
    cut = F.split("formatted", r"<\|end\|>\n")
    raw = F.filter(cut, lambda s: s != "")
    turns = F.transform(raw, lambda s: F.struct(
        _unrole(F.substring_index(F.substr(s, F.lit(len(TURN) + 1)), "\n", 1)).alias("role"),
        unescape(F.substr(s, F.instr(s, "\n") + 1)).alias("body")))
    masked = F.transform("loss", lambda m: unescape(F.substr(F.col("formatted"), (m["start"] + 1).cast("int"),
                                                          m["length"].cast("int"))))
    return chats.select("conv_id", "formatted", turns.alias("turns"), F.array_join(masked, "").alias("loss_text"))


def digest(chats: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, read from the output."""
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["body"], F.lit("\n"))), "")
    return read_back(chats).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
