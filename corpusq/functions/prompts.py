"""Prompt templates compiled to column expressions."""

from __future__ import annotations

from collections.abc import Mapping
from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

# The system and user wrapper of a chat model's input.
WRAP_OPEN = "<s>[INST]<<SYS>>\n"
WRAP_MIDDLE = "\n<</SYS>>\n\n\n"
WRAP_CLOSE = "[/INST]\n"

# Request defaults.
DEFAULT_TEMPERATURE = 1.0
DEFAULT_MAX_NEW_TOKENS = 100

DEFAULT_SYSTEM_PROMPT = "Answer briefly and only from the content given. Say so when it does not hold the answer."

# The two known styles; the wording is ours.
STYLES: Mapping[str, str] = {
    "DIRECT": "Open with the name and state the facts of the report in 25 words or less.",
    "PERSUASIVE": "Open with the name and make the case for the report in 25 words or less.",
}

REPORT_TEMPLATE = (
    "Write a report on {name}.\nPosition: {position}\nAge: {age}\nClub: {club}\n"
    "Statistics:\n{statistics}\ncontent: {text}"
)
# Fixed value: the form of a recommendation.
RECOMMEND_TEMPLATE = (
    "Have you thought of recruiting {name}? He is a {position} and currently plays for {club}. He is {summary}"
)
ANSWER_TEMPLATE = "Recommend from this report, keeping the chat so far in mind.\nChat: {history}\ncontent: {report}"


def fields(template: str) -> list[str]:
    """Placeholder names in order of appearance."""
    return [name for _, name, _, _ in Formatter().parse(template) if name is not None]


def render(template: str, values: Mapping[str, Column]) -> Column:
    """Fill ``{name}`` placeholders; a NULL value is empty, a missing variable an error."""
    missing = sorted(set(fields(template)) - set(values))
    if missing:
        raise ValueError(f"template variables without a value: {missing}")
    parts: list[Column] = []
    for literal, name, _, _ in Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name is not None:
            parts.append(F.coalesce(values[name].cast("string"), F.lit("")))
    return F.concat(*parts) if parts else F.lit("")


def wrap(system: Column, instruction: Column) -> Column:
    return F.concat(F.lit(WRAP_OPEN), system, F.lit(WRAP_MIDDLE), instruction, F.lit(WRAP_CLOSE))


def message_list(system: Column, user: Column) -> Column:
    return F.array(
        F.struct(F.lit("system").alias("role"), system.alias("content")),
        F.struct(F.lit("user").alias("role"), user.alias("content")),
    )


def style_prompt(style: Column, styles: Mapping[str, str] = STYLES) -> Column:
    """The style's system prompt; an unknown style fails the query."""
    out = F.raise_error(F.concat(F.lit("unknown prompt style: "), F.coalesce(style, F.lit("NULL")))).cast("string")
    for name, prompt in reversed(list(styles.items())):
        out = F.when(style == name, F.lit(prompt)).otherwise(out)
    return out


def strip_prompt(output: Column, prompt: Column) -> Column:
    """Drop the prompt a model echoes before its answer."""
    return F.when(F.startswith(output, prompt), F.substr(output, F.length(prompt) + 1)).otherwise(output)
