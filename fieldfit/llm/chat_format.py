"""Chat transcripts from event logs: fold the events of each message, then render.

A log has one row per event: conversation, message, sequence number, kind, role and
text. Kinds:

* ``message`` begins a message: its role, and its text so far;
* ``delta`` appends streamed text;
* ``edit`` puts a new text in place of what there was;
* ``regenerate`` discards what there was; deltas that follow build it anew.

Of every message the latest event that sets the text anew is found first, from
numbers alone and with map-side aggregation. Only events from there on are brought
together, sorted by sequence and joined, so a message that was regenerated any
number of times costs its last text. Messages meet per conversation only when they
are final.

The rendered form is ``### role:`` and a line feed, the text, ``</turn>`` and a line
feed for every message. Neither mark can occur inside a text: ``\\`` becomes ``\\\\``, a
``#`` after another gets a ``\\`` before it, as does the slash of ``</turn>`` (and a
line feed in a role becomes ``\\n``), which ``unescaped`` reverts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldfit.llm.common import stored, table

ANEW = ("message", "edit", "regenerate")
KINDS = (*ANEW, "delta")
END = "</turn>\n"
LEARNED = "assistant"
DELTA = 512  # code points of a streamed piece in the registered query


def escaped(text: Column) -> Column:
    """``text`` without any control string; NULL as empty."""
    out = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    for _ in range(2):  # runs of '#' overlap
        out = F.replace(out, F.lit("##"), F.lit("#\\#"))
    return F.replace(out, F.lit("</turn>"), F.lit("<\\/turn>"))


def unescaped(text: Column) -> Column:
    """What ``escaped`` was given."""

    def plain(part: Column) -> Column:
        for mark, sign in (("\\#", "#"), ("\\/", "/"), ("\\n", "\n")):
            part = F.replace(part, F.lit(mark), F.lit(sign))
        return part

    return F.array_join(F.transform(F.split(text, r"\\\\", -1), plain), "\\")


def folded(
    events: DataFrame,
    conv: str = "conv_id",
    message: str = "message",
    seq: str = "seq",
    kind: str = "kind",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """(``conv``, ``message``, ``role``, ``text``): the final messages of a log, one row each.

    * Events count in the order of ``seq`` within their message, NULL first; of
      equal ``seq`` those that set the text anew come before deltas, then by text. An
      event that the log holds twice counts once.
    * A NULL text counts as empty. The role is that of the latest ``message`` event;
      without one, or where it is NULL, it is empty.
    * NULL conversations and messages are keys like any other; ``message`` may be of
      any type with an order. An event of no known kind stops the run.
    * Other columns may have any name; an empty log gives an empty result.
    """
    c = {name: F.col(f"`{of}`") for name, of in dict(conv=conv, message=message, seq=seq, kind=kind, role=role, text=text).items()}
    known = F.when(c["kind"].isin(*KINDS), c["kind"]).otherwise(F.raise_error(F.concat(F.lit("unknown kind of event: "), F.coalesce(c["kind"], F.lit("NULL")))))
    # One key, never NULL itself: the join and the aggregation after it share their shuffle.
    of = F.struct(c["conv"].alias("conv"), c["message"].alias("message")).alias("of")
    log = events.select(of, c["seq"].alias("seq"), known.alias("kind"), c["role"].alias("role"), c["text"].alias("text"))
    anew = F.col("kind").isin(*ANEW)
    begins = F.col("kind") == "message"
    last = stored(
        log.groupBy("of").agg(
            F.max(F.when(anew, F.struct("seq"))).alias("since"),
            F.max(F.when(begins, F.struct(F.struct("seq"), F.coalesce("role", F.lit("")).alias("role"))))["role"].alias("role"),
        ),
        "last-resets",
    ).withColumnsRenamed({"of": "_of", "role": "_role"})
    piece = F.struct(F.struct("seq").alias("seq"), (~anew).cast("int").alias("rank"), F.coalesce("text", F.lit("")).alias("text"))
    live = (F.col("since").isNull() | (F.struct("seq") >= F.col("since"))) & (F.coalesce("text", F.lit("")) != "")
    joined = log.where(F.col("kind") != "regenerate").join(last, F.col("of") == F.col("_of"), "right")
    return (
        joined.groupBy("_of", "_role")
        .agg(F.array_join(F.sort_array(F.collect_set(F.when(live, piece)))["text"], "").alias("text"))
        .select(F.col("_of.conv").alias(conv), F.col("_of.message").alias(message), F.coalesce("_role", F.lit("")).alias(role), F.col("text").alias(text))
    )


def rendered(messages: DataFrame, conv: str = "conv_id", message: str = "message", role: str = "role", text: str = "text") -> DataFrame:
    """(``conv``, ``formatted``, ``turns``) per conversation, messages in order.

    ``turns`` has for every message where its escaped text lies in ``formatted``
    (``start``, ``stop``: code points, end exclusive) and whether it is learned
    (``loss``): the loss mask. A conversation is one value, so its length is bounded
    by that of a string.
    """
    said = F.col(f"`{role}`")
    head = F.concat(F.lit("### "), F.replace(escaped(said), F.lit("\n"), F.lit("\\n")), F.lit(":\n"))
    each = messages.select(
        F.col(f"`{conv}`").alias("conv"),
        F.col(f"`{message}`").alias("message"),
        head.alias("head"),
        escaped(F.col(f"`{text}`")).alias("body"),
        F.coalesce(said == LEARNED, F.lit(False)).alias("loss"),
    )
    order = Window.partitionBy("conv").orderBy("message", "head", "body").rowsBetween(Window.unboundedPreceding, -1)
    size = F.length("head") + F.length("body") + len(END)
    placed = each.withColumn("at", F.coalesce(F.sum(size).over(order), F.lit(0)))
    start = F.col("at") + F.length("head")
    turn = F.struct("at", F.concat("head", "body", F.lit(END)).alias("whole"), start.alias("start"), (start + F.length("body")).alias("stop"), "loss")
    return (
        placed.groupBy("conv")
        .agg(F.sort_array(F.collect_list(turn)).alias("all"))
        .select(
            F.col("conv").alias(conv),
            F.array_join("all.whole", "").alias("formatted"),
            F.transform("all", lambda t: F.struct(t["start"], t["stop"], t["loss"])).alias("turns"),
        )
    )


def formatted(events: DataFrame, conv: str = "conv_id", message: str = "message", seq: str = "seq", kind: str = "kind", role: str = "role", text: str = "text") -> DataFrame:
    """The conversations of a log as ``rendered`` gives them, from messages as ``folded`` makes them."""
    return rendered(folded(events, conv, message, seq, kind, role, text), conv, message, role, text)


def read_back(chats: DataFrame, conv: str = "conv_id") -> DataFrame:
    """(``conv``, ``turn``, ``role``, ``text``, ``learned``, ``formatted_chars``) per turn, from the rendered text alone.

    ``learned`` is the text under the loss mask, NULL for turns outside of it;
    ``formatted_chars`` is the length of the whole conversation.
    """
    whole = F.slice(F.split("formatted", END, -1), F.lit(1), F.size("turns"))
    parts = chats.select(
        F.col(f"`{conv}`").alias("conv"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
        F.posexplode(F.arrays_zip(whole.alias("part"), F.col("turns").alias("turn"))).alias("nth", "x"),
    ).select("conv", "formatted_chars", "nth", "x.part", "x.turn")
    before = Window.partitionBy("conv").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
    at = F.coalesce(F.sum(F.length("part") + len(END)).over(before), F.lit(0))
    masked = F.substring("part", (F.col("turn.start") - F.col("at") + 1).cast("int"), (F.col("turn.stop") - F.col("turn.start")).cast("int"))
    head = F.substring_index("part", "\n", 1)  # "### role:"
    return parts.withColumn("at", at).select(
        F.col("conv").alias(conv),
        F.col("nth").alias("turn"),
        unescaped(F.substring(head, F.lit(5), F.length(head) - 5)).alias("role"),
        unescaped(F.substring("part", F.length(head) + 2, F.length("part"))).alias("text"),
        F.when(F.col("turn.loss"), unescaped(masked)).alias("learned"),
        "formatted_chars",
    )


def logged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", row: str = "row") -> DataFrame:
    """An event log of finished conversations: a ``message`` event per row and its text as deltas.

    Every row is a message, repeated ones too: ``row`` tells them apart. Messages go
    by turn, then role, then a hash of the text; NULL first.
    """
    key = F.struct(
        F.col(f"`{turn}`").alias("turn"), F.col(f"`{role}`").alias("role"), F.xxhash64(F.col(f"`{text}`")).alias("text"), F.col(f"`{row}`").alias("row")
    )
    each = rows.select(F.col(f"`{conv}`").alias("conv_id"), key.alias("message"), F.col(f"`{role}`").alias("role"), F.col(f"`{text}`").alias("text"))
    none = F.lit(None).cast("string")
    begun = each.select("conv_id", "message", F.lit(0).alias("seq"), F.lit("message").alias("kind"), "role", none.alias("text"))
    streamed = each.select("conv_id", "message", F.posexplode(F.regexp_extract_all("text", F.lit(f"(?s).{{1,{DELTA}}}"), F.lit(0))).alias("nth", "text"))
    return begun.unionByName(streamed.select("conv_id", "message", (F.col("nth") + 1).alias("seq"), F.lit("delta").alias("kind"), none.alias("role"), "text"))


def digests(rows: DataFrame) -> DataFrame:
    """Digests of ``rows`` (conv_id, turn, role, text, row) as formatted conversations, read back from the output."""
    back = read_back(formatted(logged(rows)))
    turns = back.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text", "learned"))).alias("all"), F.max("formatted_chars").alias("formatted_chars"))
    learned = F.array_join(F.filter("all.learned", lambda t: t.isNotNull()), "")
    return turns.select(
        "conv_id",
        F.size("all").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(F.transform("all", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length(learned).cast("bigint").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        "formatted_chars",
    )


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``digests`` of ``conversations`` and of conversation -7, whose texts hold the template's own control strings."""
    place = F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text", place.alias("row"))
    probe = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"),
        F.struct(F.lit(0).cast("bigint").alias("file"), F.col("id").alias("at")).alias("row"),
    )
    return digests(rows.unionByName(probe))


# The rendered length from the same rules: marks around a turn, and one sign more per escape.
SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, hash(text) AS h FROM conversations
  UNION ALL
  SELECT -7, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '\### Assistant: </turn> ok', 0 FROM (VALUES (0), (1)) AS p(i)
), e AS (
  SELECT *, length(replace(replace(replace(replace(text, '\', '\\'), '##', '#\#'), '##', '#\#'), '</turn>', '<\/turn>')) AS body,
         length(replace(replace(replace(replace(replace(role, '\', '\\'), '##', '#\#'), '##', '#\#'), '</turn>', '<\/turn>'), chr(10), '\n')) AS head
  FROM c
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, h)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, h) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length('### :') + 1 + length('</turn>') + 1 + head + body)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
