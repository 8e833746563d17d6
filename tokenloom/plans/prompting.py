"""Prompts, responses and column helpers."""

from __future__ import annotations

from pyspark.sql import functions as F

from tokenloom.functions import constants as C
from tokenloom.functions import prompts as P
from tokenloom.operators import columns
from tokenloom.operators.metrics import every_nth as keep_every_nth
from tokenloom.plans.registry import PAIR_KEY, PAIRS_SQL, pairs, query, sql_text
from tokenloom.sources.readers import read_table
from tokenloom.sources.views import opening_turns


def template_sql(template: str, **fields: str) -> str:
    """SQL text of a filled template."""
    parts, rest = [], template
    while rest:
        head, brace, tail = rest.partition("{")
        if head:
            parts.append(sql_text(head))
        if brace:
            name, _, tail = tail.partition("}")
            parts.append(fields[name])
        rest = tail
    return "(" + " || ".join(parts) + ")"


PROMPT_SQL = template_sql(C.SQL_TEMPLATE, question="question", context="coalesce(context, '')", output="''")
ANSWERED_SQL = template_sql(C.SQL_TEMPLATE, question="question", context="coalesce(context, '')", output="answer")
BY_CONTEXT_SQL = (
    "CASE WHEN context IS NULL OR trim(context) = '' THEN "
    + template_sql(C.WITHOUT_CONTEXT_TEMPLATE, question="question")
    + " ELSE "
    + template_sql(C.WITH_CONTEXT_TEMPLATE, question="question", context="context")
    + " END"
)
SUPPORT_SQL = template_sql(C.SUPPORT_TEMPLATE, query="text")


def open_prompt():
    return P.prompt_sql(F.col("question"), F.col("context"))


def answered_prompt():
    return P.prompt_sql(F.col("question"), F.col("context"), F.col("answer"))


@query("prompt_sql", f"WITH {PAIRS_SQL} SELECT conv_id, turn, {PROMPT_SQL} AS prompt, {ANSWERED_SQL} AS answered FROM pairs")
def prompt_sql(spark, folder):
    return pairs(spark, folder).select(*PAIR_KEY, open_prompt().alias("prompt"), answered_prompt().alias("answered"))


@query("prompt_by_context", f"WITH {PAIRS_SQL} SELECT conv_id, turn, {BY_CONTEXT_SQL} AS prompt FROM pairs")
def prompt_by_context(spark, folder):
    return pairs(spark, folder).select(*PAIR_KEY, P.prompt_by_context(F.col("question"), F.col("context")).alias("prompt"))


@query("prompt_support", f"SELECT conv_id, turn, {SUPPORT_SQL} AS prompt FROM conversations WHERE role = 'user'")
def prompt_support(spark, folder):
    asked = read_table(spark, folder, "conversations").where(F.col("role") == "user")
    return asked.select("conv_id", "turn", P.prompt_support(F.col("text")).alias("prompt"))


@query(
    "prompt_turns",
    "SELECT a.conv_id, " + template_sql(C.TURNS_TEMPLATE, user="a.text", assistant="b.text") + """ AS prompt
     FROM conversations a JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = 1 WHERE a.turn = 0""",
)
def prompt_turns(spark, folder):
    chats = opening_turns(read_table(spark, folder, "conversations"))
    return chats.select("conv_id", P.prompt_turns(F.col("turns")).alias("prompt"))


@query("select_text", "SELECT doc_id, text FROM documents")
def select_text(spark, folder):
    return columns.select_text(read_table(spark, folder, "documents"), "text", keep=("doc_id",))


FREE_TEMPLATE = "Q({conv_id}.{turn}): {question}\nA: {answer}"


@query(
    "render_template",
    f"WITH {PAIRS_SQL} SELECT conv_id, turn, "
    + template_sql(FREE_TEMPLATE, conv_id="conv_id::VARCHAR", turn="turn::VARCHAR", question="question", answer="answer")
    + " AS prompt FROM pairs",
)
def render_template(spark, folder):
    return P.render_template(pairs(spark, folder), FREE_TEMPLATE).select(*PAIR_KEY, "prompt")


STRIP = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"


@query(
    "extract_response",
    f"""WITH {PAIRS_SQL} SELECT conv_id, turn,
        {STRIP.format(f"split_part({ANSWERED_SQL}, '### Response:', 2)")} AS response,
        CASE WHEN contains(question, '### Response:') THEN 'found' END AS without_marker FROM pairs""",
)
def extract_response(spark, folder):
    return pairs(spark, folder).select(
        *PAIR_KEY,
        P.extract_response(answered_prompt()).alias("response"),
        P.extract_response(F.col("question")).alias("without_marker"),
    )


@query(
    "strip_prompt",
    f"""WITH {PAIRS_SQL} SELECT conv_id, turn, answer AS completion,
        CASE WHEN starts_with(answer, question) THEN substr(answer, length(question) + 1) END AS no_prefix FROM pairs""",
)
def strip_prompt(spark, folder):
    prompt = P.prompt_by_context(F.col("question"), F.col("context"))
    return pairs(spark, folder).withColumn("prompt", prompt).select(
        *PAIR_KEY,
        P.strip_prompt(F.concat("prompt", "answer"), F.col("prompt")).alias("completion"),
        P.strip_prompt(F.col("answer"), F.col("question")).alias("no_prefix"),
    )


@query("every_nth", "SELECT event_id, event_type, value FROM events WHERE event_id % 100 = 0")
def every_nth(spark, folder):
    events = read_table(spark, folder, "events").select("event_id", "event_type", "value")
    return keep_every_nth(events, "event_id", 100)


@query(
    "add_columns",
    f"""WITH {PAIRS_SQL} SELECT conv_id, turn, length(question) AS question_chars, length(answer) AS answer_chars,
        context IS NOT NULL AS has_context, md5(question || answer) AS row_hash FROM pairs""",
)
def add_columns(spark, folder):
    wide = columns.add_columns(
        pairs(spark, folder),
        {
            "question_chars": F.char_length("question").cast("bigint"),
            "answer_chars": F.char_length("answer").cast("bigint"),
            "has_context": F.col("context").isNotNull(),
            "row_hash": lambda df: F.md5(F.concat(df.question, df.answer)),
        },
    )
    return wide.drop("question", "context", "answer")
