"""Text functions: built-in expressions where they can say it, Arrow batches where not."""

from __future__ import annotations

import ast
import json
import re
from collections.abc import Callable, Sequence
from functools import cache

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from quarry.model import strip
from quarry.session import ship


def lazy_udf(kind: str, own_step: bool = False) -> Callable:
    """A pandas UDF that is made when it is first used in an application: types need a session, and
    workers need the package.

    With ``own_step`` Spark keeps the call in a projection of its own, so that its result can be
    used within a lambda, where Python functions can't be called."""

    def wrap(f: Callable) -> Callable:
        plain = lambda: F.pandas_udf(f, kind)
        made = cache(lambda _: plain().asNondeterministic() if own_step else plain())

        def column(*columns: Column | str) -> Column:
            context = ship(SparkSession.active()).sparkContext
            return made(context.applicationId)(*columns)

        return column

    return wrap


# Names of assistants and their makers.
ASSISTANT_KEYWORDS = (
    "chatgpt", "chat gpt", "Chat-gpt", "gpt3", "gpt4", "gpt5", "gpt-3", "gpt-4", "gpt-5",
    "openai", "open-ai", "open ai", "openassistant", "open assistant", "open-assistant", "eurollm", "euroblock",
)

# What stands for characters that file names shouldn't hold.
NAME_REPLACEMENTS = {"/": "_", "\\": "_", ":": "-", "*": "star", "?": "q", '"': "", "<": "lt", ">": "gt", "|": "_", "\n": "_", "\r": "_", "\t": "_", " ": "_", ".": "_"}


def conversation_id(source: Column, content: Column, sample_id: Column | None = None) -> Column:
    """Source prefix, sample id if there is one, and a digest of the content."""
    prefix = F.translate(source, "/-", "__")
    digest = F.sha2(content, 256)
    long = F.concat_ws("_", prefix, F.substring(digest, 1, 16))
    if sample_id is None:
        return long
    short = F.concat_ws("_", prefix, sample_id, F.substring(digest, 1, 8))
    return F.when(sample_id.isNotNull() & (sample_id != ""), short).otherwise(long)


def short_id(*content: Column) -> Column:
    """Twelve hexadecimal digits of the content's digest."""
    return F.substring(F.sha2(F.concat(*content), 256), 1, 12)


def has_keyword(text: Column, keyword: str) -> Column:
    """The keyword, whatever its case, with no letter, digit or _ on either side."""
    edge = r"[^\p{L}\p{N}_]"
    word = re.sub(r"([.^$*+?()\[\]{}|\\])", r"\\\1", keyword.lower())
    return F.lower(text).rlike(f"(^|{edge}){word}($|{edge})")


_EDGE = r"[\p{L}\p{N}_]"


def trie_pattern(keywords: Sequence[str]) -> str:
    """One pattern for many keywords: what they begin with alike is tried once, and the longest that fits is taken."""
    root: dict = {}
    for k in keywords:
        at = root
        for c in k:
            at = at.setdefault(c, {})
        at[""] = {}

    def built(at: dict) -> str:
        ways = [re.sub(r"([.^$*+?()\[\]{}|\\])", r"\\\1", c) + built(below) for c, below in sorted(at.items()) if c]
        if not ways:
            return ""
        one = ways[0] if len(ways) == 1 and "" not in at else "(?:" + "|".join(ways) + ")"
        return one + "?" if "" in at else one

    return built(root)


def keywords_in(text: Column, keywords: Sequence[str] = ASSISTANT_KEYWORDS) -> Column:
    """The keywords found, in the list's order.

    One pass over the lower-cased text, however many keywords there are: at each place where a word begins the longest keyword that ends
    at a word's edge is taken; which shorter ones it stands for, as "gpt" in "gpt-4", is known beforehand.
    """
    low = [k.lower() for k in keywords]
    edge = re.compile(r"[^\W_]|_", re.UNICODE).match

    def stands_for(longest: str) -> list[int]:
        """Places of the keywords that ``longest`` begins with, up to an edge."""
        return [i for i, k in enumerate(low) if longest == k or (longest.startswith(k) and not edge(longest, len(k)))]

    # A look-ahead takes no text, so keywords that overlap are all found.
    pattern = f"(?<!{_EDGE})(?=({trie_pattern(sorted(set(low) - {''}))})(?!{_EDGE}))"
    known = F.from_json(F.lit(json.dumps({k: stands_for(k) for k in set(low)})), "map<string,array<int>>")
    names = F.array(*[F.lit(k) for k in keywords])
    found = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(1)))
    places = F.array_sort(F.array_distinct(F.flatten(F.transform(found, lambda k: F.try_element_at(known, k)))))
    named = F.transform(places, lambda i: F.get(names, i))
    return F.when(F.size(found) > 0, named).otherwise(F.array().cast("array<string>"))


THINK = r"(?is)<think\s*>(.*?)</think\s*>"


def thoughts(text: Column) -> Column:
    """Contents of the think blocks, stripped, blank ones left out."""
    found = F.regexp_extract_all(text, F.lit(THINK), F.lit(1))
    return F.filter(F.transform(found, strip), lambda x: x != "")


def without_thoughts(text: Column) -> Column:
    return strip(F.regexp_replace(text, THINK, ""))


def squeeze_lines(text: Column) -> Column:
    """Two or more blank lines become one; ends stripped."""
    return F.regexp_replace(strip(text), r"\n\s*\n\s*\n+", "\n\n")


def squeeze_blanks(text: Column) -> Column:
    """Blank lines, also those that hold white space, become one; runs of spaces too; ends stripped."""
    return F.regexp_replace(F.regexp_replace(strip(text), r"\n\s*\n", "\n\n"), " +", " ")


# What counts as a link or an image, case ignored.
LINKS = "(?i)" + "|".join((r"!\[.*?\]\(.*?\)", "https?://", r"\.com", r"\.org", r"\.net", r"\.edu", r"cdn\."))


def has_link(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).rlike(LINKS)


def file_name(value: Column, most: int = 50) -> Column:
    """A value as a part of a file name."""
    name = value
    for old, new in NAME_REPLACEMENTS.items():
        name = F.replace(name, F.lit(old), F.lit(new))
    name = F.regexp_replace(name, r"[^\p{L}\p{N}_-]", "_")
    name = F.regexp_replace(F.regexp_replace(name, "_{2,}", "_"), "^_+|_+$", "")
    cut = F.when(F.length(name) > most, F.concat(F.substring(name, 1, most), F.lit("_trunc"))).otherwise(name)
    special = F.when(value.isNull() | value.isin("None", "<NULL>"), "NULL").when(value == "", "EMPTY")
    return F.coalesce(special, F.when(cut == "", "UNNAMED").otherwise(cut))


def unbox(text: str) -> tuple[str, list[str]]:
    """The text with each ``\\boxed{...}`` replaced by its content, and the contents.

    Braces inside are balanced; a box that isn't closed stays as it is.
    """
    out, found, at = [], [], 0
    while (start := text.find("\\boxed{", at)) >= 0:
        depth, end = 1, start + 7
        while end < len(text) and depth:
            depth += {"{": 1, "}": -1}.get(text[end], 0)
            end += 1
        if depth:  # no closing brace: later boxes may still have one
            out.append(text[at : start + 1])
            at = start + 1
            continue
        out += [text[at:start], text[start + 7 : end - 1]]
        found.append(text[start + 7 : end - 1])
        at = end
    return "".join([*out, text[at:]]), found


@lazy_udf("struct<text:string,answers:array<string>>")
def boxed(texts: pd.Series) -> pd.DataFrame:
    rows = [unbox(t) if t else (t, []) for t in texts]
    return pd.DataFrame(rows, columns=["text", "answers"])


@lazy_udf("array<struct<text:string,answers:array<string>>>", own_step=True)
def boxed_each(texts: pd.Series) -> pd.Series:
    """:func:`boxed` for every item of an array."""
    return texts.map(lambda xs: None if xs is None else [dict(zip(("text", "answers"), unbox(t) if t else (t, []), strict=True)) for t in xs])


_FENCE = re.compile(r"```([A-Za-z0-9_-]+)\s*\n(.*?)```", re.S)


def fenced_parts(text: str | None) -> list[dict[str, str]]:
    """Parts of a text with fences, in order: python is a call of ``execute_python``,
    output its result, anything else a response."""
    text, out, at = text or "", [], 0

    def say(kind: str, content: str = "", name: str = "", args: str = "") -> None:
        if kind != "response" or content:
            out.append({"type": kind, "content": content, "name": name, "args": args})

    for m in _FENCE.finditer(text):
        say("response", text[at : m.start()].strip())
        kind, body = m[1].lower(), m[2].strip()
        if kind == "python":
            say("function-call", name="execute_python", args=json.dumps({"code": body}))
        elif kind == "output":
            say("function-output", body)
        else:
            say("response", m[0].strip())
        at = m.end()
    say("response", text[at:].strip())
    return out


@lazy_udf("array<struct<type:string,content:string,name:string,args:string>>")
def fences(texts: pd.Series) -> pd.Series:
    return texts.map(fenced_parts)


@lazy_udf("array<array<struct<type:string,content:string,name:string,args:string>>>", own_step=True)
def fences_each(texts: pd.Series) -> pd.Series:
    """:func:`fences` for every item of an array."""
    return texts.map(lambda xs: None if xs is None else [fenced_parts(t) for t in xs])


_STRING_OR_BRACE = re.compile(r'"(?:\\.|[^"\\])*(?:"|$)|[{}]', re.S)


def top_objects(text: str | None) -> list[str]:
    """The JSON objects with a name that stand at the top level of a text.

    Braces in quotes don't count, wherever the quotes stand; a closing brace too many hides what follows.
    """
    out, depth, start = [], 0, None
    for mark in _STRING_OR_BRACE.finditer(text or ""):
        if mark[0] == "{":
            start = mark.start() if depth == 0 else start
            depth += 1
        elif mark[0] == "}":
            depth -= 1
            if depth == 0 and start is not None:
                body, start = text[start : mark.end()], None
                try:
                    named = json.loads(body).get("name")
                except ValueError:
                    continue
                if named:
                    out.append(body)
    return out


@lazy_udf("array<string>")
def json_objects(texts: pd.Series) -> pd.Series:
    return texts.map(top_objects)


def repaired(text: str | None) -> str | None:
    """A model's JSON answer made readable: outer braces only, sound escapes, no
    commas before a closing bracket, inner quotes escaped where a line shows them."""
    if text is None or "{" not in text or "}" not in text:
        return text
    text = text[text.index("{") : text.rindex("}") + 1]
    text = re.sub(r'\\(?!["\\/bfnrt]|u[0-9a-fA-F]{4})', r"\\\\", text)
    lines = []
    for line in text.split("\n"):
        m = re.match(r'^(\s*"[^"]*"\s*:\s*")(.*)("\s*,?\s*)$', line)
        lines.append(m[1] + re.sub(r'(?<!\\)"', r"\"", m[2]) + m[3] if m else line)
    return re.sub(r",(\s*[}\]])", r"\1", "\n".join(lines))


@lazy_udf("string")
def repair_json(texts: pd.Series) -> pd.Series:
    return texts.map(repaired)


def literal_json(text: str | None) -> str | None:
    """A Python literal as JSON, null if it isn't one."""
    try:
        return json.dumps(ast.literal_eval(text))
    except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
        return None


@lazy_udf("string")
def python_literal(texts: pd.Series) -> pd.Series:
    return texts.map(literal_json)
