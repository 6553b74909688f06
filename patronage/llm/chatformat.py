r"""Chat formatting in budgeted windows.

A turn is written ``<|im_start|>role\ntext<|im_end|>\n``. Inside roles and texts every ``<|`` becomes ``<\|`` (and ``<\|`` becomes
``<\\|``, and so on), so control strings stand only where the template puts them, and the way back is exact; in a role ``%`` and line
ends are written %25 and %0A.

Prefix sums of turn tokens cut a conversation into turn-aligned spans: a span takes turns as long as they fit beside the system
turn and the history. A window is the system turn (the first turn, if it is one), the last turns of the span before as far as the
history budget and the window's own go, and the span. Only assistant texts of the span are targets, so each is a target once; what is
repeated is masked. Built-in expressions only. Prefix sums are taken in blocks of turns and spans in chunks of CHUNK_SPANS budgets (a span
ends with its chunk), so no step but the caller's own digest holds a whole conversation.

Tokens are counted by the caller, in a column, or bounded from above: a token of a tokenizer on bytes holds a byte or more, and
NFC and lower-casing make a character that is not ASCII at most three times as long.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUDGET, HISTORY = 1024, 128
BLOCK = 256
#: Budgets of tokens that are cut into spans together.
CHUNK_SPANS = 16

# Control strings of the template.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def escaped(text: str) -> str:
    return rf"regexp_replace({text}, '<(\\\\*)\\|', '<\\\\$1|')"


def unescaped(text: str) -> str:
    return rf"regexp_replace({text}, '<\\\\(\\\\*)\\|', '<$1|')"


def _role_out(role: str) -> str:
    return escaped(f"replace(replace({role}, '%', '%25'), '\\n', '%0A')")


def _role_in(role: str) -> str:
    return f"replace(replace({unescaped(role)}, '%0A', '\\n'), '%25', '%')"


def token_bound(role: str = "role", text: str = "text") -> str:
    """At least the tokens of a turn as it is written, for any tokenizer on UTF-8 bytes that normalises by NFC and lower case at most."""
    said = f"concat('{OPEN}', {_role_out(role)}, '\\n', {escaped(text)}, '{CLOSE}\\n')"
    return f"CAST(octet_length({said}) + 2 * octet_length(regexp_replace({said}, '[\\\\x00-\\\\x7F]+', '')) AS BIGINT)"


def windows(rows: DataFrame, budget: int = BUDGET, history: int = HISTORY, tokens: str | None = None) -> DataFrame:
    """``conv_id``, ``start``, ``formatted``, ``fresh_from``, ``targets`` of each window of ``rows`` (conv_id, turn, role, text).

    ``start``: tokens of the conversation before the window's span, which orders the windows. ``fresh_from``: code points before the
    span, that is the length of what is repeated. ``targets``: (from, to) in code points of the texts under the loss mask, end exclusive.
    ``tokens`` names a column with the tokens of each turn as it is written (null or less than 1: 1); without it, ``token_bound`` is taken.
    No window exceeds the budget unless the system turn and a single turn do. Turns are ordered by turn, then role, then text, then
    tokens; null turns come first; repeated rows are turns. Null roles and texts are empty. Null conv_ids are one conversation.
    An empty table gives no rows; other columns are ignored.
    """
    count = "CAST(NULL AS BIGINT)" if tokens is None else f"coalesce(greatest(CAST(`{tokens}` AS BIGINT), 1L), 1L)"
    turns = rows.selectExpr("CAST(conv_id AS BIGINT) AS conv_id", "CAST(turn AS BIGINT) AS turn", "coalesce(CAST(role AS STRING), '') AS role",
                            "coalesce(CAST(text AS STRING), '') AS text", f"{count} AS tokens")
    if tokens is None:
        turns = turns.withColumn("tokens", F.expr(token_bound()))
    turns = turns.selectExpr("coalesce(CAST(conv_id AS STRING), 'null') AS key", "conv_id", "turn", "role", "text", f"coalesce(turn div {BLOCK}, {-(1 << 60)}) AS block", "tokens")
    order = "ORDER BY turn NULLS FIRST, role, text, tokens ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    inside = turns.selectExpr("*", f"sum(tokens) OVER (PARTITION BY key, block {order}) AS until")
    blocks = turns.groupBy("key", "block").agg(F.sum("tokens").alias("all")).selectExpr("key", "block", "sum(all) OVER (PARTITION BY key ORDER BY block) - all AS before")
    placed = inside.join(blocks, ["key", "block"]).selectExpr("key", "conv_id", "role", "text", "tokens", "before + until - tokens AS a", "before + until AS b")
    system = placed.filter("a = 0 AND role = 'system'").selectExpr("key", "role AS system_role", "text AS system_text", "tokens AS system_tokens")
    placed = placed.join(system, "key", "left").withColumn("head", F.expr("coalesce(system_tokens, 0L)"))
    placed = placed.withColumn("room", F.expr(f"CASE WHEN {budget}L - head - {history}L >= {max(1, budget // 4)}L THEN {budget}L - head - {history}L ELSE greatest({budget}L - head, 1L) END"))
    # places from the end of the system turn, which belongs to the first span and takes no room there
    placed = placed.selectExpr("*", "greatest(a, head) AS p", "greatest(b, head) AS q").withColumn("chunk", F.expr(f"(p - head) div ({CHUNK_SPANS} * room)"))
    ends = placed.groupBy("key", "chunk", "head", "room").agg(F.array_sort(F.collect_list(F.struct("p", "q"))).alias("ends"))
    cuts = ends.selectExpr(
        "key", "chunk", "head", "array_max(transform(ends, x -> x.q)) AS last",
        "aggregate(ends, array(ends[0].p), (s, x) -> IF(x.q - element_at(s, -1) > room AND x.p > element_at(s, -1), array_append(s, x.p), s)) AS starts")
    cuts = cuts.selectExpr("key", "chunk", "head", "transform(starts, (s, i) -> struct(s AS first, coalesce(get(starts, i + 1), last) AS stop)) AS spans")
    placed = placed.join(cuts.drop("head"), ["key", "chunk"]).withColumn("span", F.expr("array_max(filter(spans, s -> s.first <= p))"))
    placed = placed.selectExpr("key", "conv_id", "role", "text", "a", "p", "head", "system_role", "system_text", "span.first AS first", "span.stop AS stop",
                               "IF(span.first = head, 0L, span.first) AS start")
    spans = cuts.selectExpr("key", "head", "inline(spans)")
    following = spans.selectExpr("key", "first AS stop", f"least({history}L, greatest({budget}L - head - (stop - first), 0L)) AS left")
    part = "struct(a, {} AS again, role, text) AS part".format
    fresh = placed.selectExpr("key", "conv_id", "start", part("false"))
    kept = placed.filter(f"a >= head AND p >= stop - {history}").join(following, ["key", "stop"]).filter("p >= stop - left")
    kept = kept.selectExpr("key", "conv_id", "stop AS start", part("true"))
    heads = placed.filter("p = first AND start > 0 AND system_text IS NOT NULL").selectExpr(
        "key", "conv_id", "start", "struct(0L AS a, true AS again, system_role AS role, system_text AS text) AS part")
    grouped = fresh.union(kept).union(heads).groupBy("key", "conv_id", "start").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    written = grouped.selectExpr("conv_id", "start", f"transform(parts, p -> struct(p.again AS again, p.role = 'assistant' AS said, {_role_out('p.role')} AS role, {escaped('p.text')} AS text)) AS p")
    around = len(OPEN) + 1 + len(CLOSE) + 1
    sized = written.selectExpr(
        "conv_id", "start", "p", f"aggregate(p, array(0), (s, x) -> array_append(s, element_at(s, -1) + char_length(x.role) + char_length(x.text) + {around})) AS at")
    return sized.selectExpr(
        "conv_id", "start", f"concat_ws('', transform(p, x -> concat('{OPEN}', x.role, '\\n', x.text, '{CLOSE}\\n'))) AS formatted",
        "at[size(filter(p, x -> x.again))] AS fresh_from",
        f"filter(transform(p, (x, i) -> IF(x.said AND NOT x.again, struct(at[i] + {len(OPEN) + 1} + char_length(x.role) AS from, at[i + 1] - {len(CLOSE) + 1} AS to), NULL)), x -> x IS NOT NULL) AS targets")


def turns(formatted: DataFrame) -> DataFrame:
    """``conv_id``, ``start``, ``turns`` (role and text of the span's turns), ``losses`` (texts under the mask), both unescaped, and the
    length of each window, from the windows' text and offsets alone. A window gives a row, also if it is repeated; null conv_ids
    stay null; an empty table gives no rows; other columns are ignored."""
    fresh = formatted.selectExpr("*", f"split(substring(formatted, fresh_from + 1), '<\\\\|im_end\\\\|>\\n') AS pieces")
    parted = fresh.selectExpr("*", f"transform(slice(pieces, 1, size(pieces) - 1), x -> substring(x, {len(OPEN) + 1})) AS said")
    return parted.selectExpr(
        "conv_id", "start", f"transform(said, x -> struct({_role_in('substring_index(x, chr(10), 1)')} AS role, {unescaped('substring(x, locate(chr(10), x) + 1)')} AS text)) AS turns",
        f"transform(targets, t -> {unescaped('substring(formatted, t.from + 1, t.to - t.from)')}) AS losses", "CAST(char_length(formatted) AS BIGINT) AS chars")


def digests(formatted: DataFrame) -> DataFrame:
    """One row for each conversation, read back from its windows: ``conv_id``, ``n_turns``, ``turns_sha256``, ``loss_chars``,
    ``loss_sha256``, ``formatted_chars``. A digest is of one string, so a conversation's texts meet in one row here. Windows with
    a null conv_id are one conversation; repeated windows count as often as they occur; an empty table gives no rows."""
    read = turns(formatted).selectExpr(
        "conv_id", "start", "CAST(size(turns) AS BIGINT) AS n", "concat_ws('', transform(turns, t -> concat(t.role, '\\n', t.text, '\\n'))) AS said",
        "concat_ws('', losses) AS loss", "chars")
    whole = read.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("start", "said", "loss"))).alias("w"), F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"))
    whole = whole.selectExpr("conv_id", "n_turns", "concat_ws('', w.said) AS said", "concat_ws('', w.loss) AS loss", "formatted_chars")
    return whole.selectExpr("conv_id", "n_turns", "sha2(said, 256) AS turns_sha256", "CAST(char_length(loss) AS BIGINT) AS loss_chars", "sha2(loss, 256) AS loss_sha256", "formatted_chars")
