"""Templates, patterns, special names and code books that results depend on."""

# --- fixed values -----------------------------------------------------------------------
# Prompt templates. Blanks, missing line breaks and indents are part of the format.
SQL_TEMPLATE = """You are a powerful text-to-SQL model. Your job is to answer questions about a database. You are given a question and context regarding one or more tables. 

You must output the SQL query that answers the question.

### Input:
{question}

### Context:
{context}

### Response:
{output}"""

WITH_CONTEXT_TEMPLATE = (
    "You are a powerful text-to-SQL model. Your job is to answer questions correctly about a database. You are given a question, paired with a context regarding one or more tables that provides further info about database schema. "
    "You must output the SQL query that correctly answers the question with specific field in context if provided."
    "### Question:\n{question}\n\n### Context:\n{context}\n\n### Answer:"
)

WITHOUT_CONTEXT_TEMPLATE = (
    "You are a powerful text-to-SQL model. Your job is to answer questions correctly about a database. You are given a question. "
    "You must output the SQL query that correctly answers the question with specific field in context if provided."
    "### Question:\n{question}\n\n### Answer:"
)

SUPPORT_TEMPLATE = """Answer the following question truthfully.
    If you don't know the answer, respond 'Sorry, I don't know the answer to this question.'.
    If the question is too complex, respond 'Kindly, consult a psychiatrist for further queries.'.

    <HUMAN>: {query}
    <ASSISTANT>: 
    """

TURNS_TEMPLATE = "### USER: {user}\n### ASSISTANT: {assistant}"

RESPONSE_MARKER = "### Response:"

# Piece patterns: SIMPLE has the same meaning in RE2 and Java, FULL keeps white space (lossless).
SIMPLE_PATTERN = r"\p{L}+|\p{N}{1,3}|[^\s\p{L}\p{N}]+"
FULL_PATTERN = r"(?i:'s|'t|'re|'ve|'m|'ll|'d)|[^\r\n\p{L}\p{N}]?\p{L}+|\p{N}{1,3}| ?[^\s\p{L}\p{N}]+[\r\n]*|\s*[\r\n]+|\s+(?!\S)|\s+"

# Special names, in id order; the reserved names 5 to 250 follow the ten named ones.
NAMED_SPECIALS = (
    "<|begin_of_text|>",
    "<|end_of_text|>",
    "<|reserved_special_token_0|>",
    "<|reserved_special_token_1|>",
    "<|reserved_special_token_2|>",
    "<|reserved_special_token_3|>",
    "<|start_header_id|>",
    "<|end_header_id|>",
    "<|reserved_special_token_4|>",
    "<|eot_id|>",
)
RESERVED_NAME = "<|reserved_special_token_{}|>"
FIRST_RESERVED, LAST_RESERVED = 5, 250

# Label value ignored by the loss.
IGNORE_LABEL = -100

# Rotation base and normalization epsilon.
ROPE_THETA = 500000.0
NORM_EPS = 1e-5

# 4-bit normal-float code book (published with the QLoRA paper).
NF4_CODES = (
    -1.0,
    -0.6961928009986877,
    -0.5250730514526367,
    -0.39491748809814453,
    -0.28444138169288635,
    -0.18477343022823334,
    -0.09105003625154495,
    0.0,
    0.07958029955625534,
    0.16093020141124725,
    0.24611230194568634,
    0.33791524171829224,
    0.44070982933044434,
    0.5626170039176941,
    0.7229568362236023,
    1.0,
)
# --- end of fixed values ----------------------------------------------------------------


def special_names() -> list[str]:
    """All special names in id order."""
    reserved = [RESERVED_NAME.format(i) for i in range(FIRST_RESERVED, LAST_RESERVED + 1)]
    return [*NAMED_SPECIALS, *reserved]
