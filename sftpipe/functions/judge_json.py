"""Prompts for a judge model and typed reading of its JSON answers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sftpipe.functions.text import prefix

# Fixed values.
DIMENSIONS = ("complexity", "clarity", "informativeness")
PROMPT_ANSWER_CHARS = 1500
PROMPT_HEAD = """你是一名严格的法律数据质量评审。请对下面这条"法律问答"从三个维度打分(1-5 分,5 最好):
- complexity:问题的专业性/复杂度(越是真实、有难度的法律问题分越高)
- clarity:答案表达是否清晰、有条理
- informativeness:答案信息量是否充足、是否真正解决问题

只输出一个 JSON,不要任何多余文字,格式:
{"complexity": 整数, "clarity": 整数, "informativeness": 整数, "reason": "一句话理由"}

【问题】"""
PROMPT_MIDDLE = "\n【答案】"

# Python's name for each JSON type that is not an object.
_PYTHON_TYPES = {
    "ARRAY": "list",
    "STRING": "str",
    "BIGINT": "int",
    "DECIMAL": "float",
    "DOUBLE": "float",
    "BOOLEAN": "bool",
    "VOID": "NoneType",
}


def judge_prompt(question: Column, answer: Column, chars: int = PROMPT_ANSWER_CHARS) -> Column:
    """The prompt about a pair, with the first ``chars`` characters of the answer."""
    return F.concat(F.lit(PROMPT_HEAD), question, F.lit(PROMPT_MIDDLE), prefix(answer, chars))


def variant_type(v: Column) -> Column:
    return F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)


def parse_response(content: Column) -> Column:
    """VARIANT of one complete JSON text, null otherwise.

    ``try_parse_json`` ignores what follows the first value. No trailing text can
    be valid both inside a list and inside an object, so parsing it in both
    wrappers accepts complete texts only.
    """
    in_list = F.try_parse_json(F.concat(F.lit("["), content, F.lit("]")))
    in_object = F.try_parse_json(F.concat(F.lit('{"v":'), content, F.lit("}")))
    return F.when(in_object.isNotNull(), F.try_variant_get(in_list, "$[0]", "variant"))


def response_error(content: Column) -> Column:
    """Null for a JSON object, else ``Type: message``."""
    parsed = parse_response(content)
    kind = variant_type(parsed)
    name = F.create_map(*[F.lit(x) for pair in _PYTHON_TYPES.items() for x in pair])[kind]
    return (
        F.when(content.isNull(), F.lit("TypeError: the response has no content"))
        .when(parsed.isNull(), F.lit("JSONDecodeError: the response is not valid JSON"))
        .when(kind != "OBJECT", F.format_string("TypeError: '%s' object is not a mapping", name))
    )


def numeric_field(v: Column, field: str) -> Column:
    """DOUBLE when the JSON value is a number, 1/0 for a boolean, else null."""
    kind = variant_type(F.try_variant_get(v, f"$.{field}", "variant"))
    number = F.try_variant_get(v, f"$.{field}", "double")
    return F.when(kind.isin("BIGINT", "DECIMAL", "DOUBLE", "BOOLEAN"), number)


def has_field(v: Column, field: str) -> Column:
    """Whether the object has the field; it may be null."""
    return F.try_variant_get(v, f"$.{field}", "variant").isNotNull()


def text_field(v: Column, field: str) -> Column:
    """The JSON value as text: strings as they are, other types as JSON; null when absent or null."""
    item = F.try_variant_get(v, f"$.{field}", "variant")
    return (
        F.when(F.is_variant_null(item), F.lit(None).cast("string"))
        .when(F.schema_of_variant(item) == "STRING", F.try_variant_get(v, f"$.{field}", "string"))
        .otherwise(F.to_json(item))
    )
