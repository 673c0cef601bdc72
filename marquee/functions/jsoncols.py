"""JSON list columns (genres, production companies).

Raw input holds Python-literal text such as ``[{'id': 16, 'name': 'Animation'}]``.
The result is the whole list as canonical JSON text: every key and value, with
its type, keys sorted, no spaces.

Three ways, each for what the one before leaves:

* lists whose elements are exactly an integer ``id`` and a plain string
  ``name`` are recognised by a pattern, which writes them as JSON too;
* lists of flat dicts with any keys, strings with escapes, numbers, ``None``
  and booleans are read by a grammar over their tokens (:func:`flat_lists`),
  all in built-in functions;
* all other text that looks like a list (nested values, odd numbers, joined
  strings, text after the list) goes to one Arrow-batched ``pandas_udf`` that
  runs ``ast.literal_eval``; every other row reaches that UDF as NULL and costs
  nothing.
"""

from __future__ import annotations

import ast
import json
import warnings

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Element type that readers of the canonical text use for genres and companies.
COMPANY_ARRAY = "array<struct<id:bigint,name:string>>"

_GAP = r"[ \t\r\n]*+"
_STRING = r"""(?:'([^'"\\\p{Cntrl}]*+)'|"([^"'\\\p{Cntrl}]*+)")"""
_ID = rf"""{_GAP}(?:'id'|"id"){_GAP}:{_GAP}(0|-?[1-9][0-9]{{0,17}}){_GAP}"""
_NAME = rf"""{_GAP}(?:'name'|"name"){_GAP}:{_GAP}{_STRING}{_GAP}"""
# One plain element with the gaps around it, and its JSON text; _MARK stands before and behind that in what is made of the text.
_ELEMENT = rf"{_GAP}\{{(?:{_ID},{_NAME}|{_NAME},{_ID})\}}{_GAP}"
_ELEMENT_JSON = '\x01{"id":$1$6,"name":"$2$3$4$5"}\x01'
_MARK = "\x01"


def _literal_list_to_json(text: str | None) -> tuple[str | None, str | None]:
    """(canonical JSON, None) or (None, reason).  Running out of memory fails
    the task: whether a row is valid must not depend on a worker's memory.
    The parser reports a text that overflows its stack as a memory error too,
    but with a message."""
    if text is None:
        return None, None
    try:
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")  # of escapes that mean nothing
            value = ast.literal_eval(text.strip())
    except RecursionError:
        return None, "too_deep"
    except MemoryError as e:
        if not e.args:
            raise
        return None, "unparseable"
    except (ValueError, SyntaxError, TypeError):
        return None, "unparseable"
    if not isinstance(value, list) or not all(isinstance(v, dict) for v in value):
        return None, "unparseable"
    try:
        out = json.dumps(value, sort_keys=True, ensure_ascii=False, allow_nan=False, separators=(",", ":"))
        out.encode()  # half of a surrogate pair is no text
        return out, None
    except RecursionError:
        return None, "too_deep"
    except (TypeError, ValueError):
        return None, "unparseable"


@F.pandas_udf(StructType([StructField("json", StringType()), StructField("reason", StringType())]))
def _literal_to_json(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([_literal_list_to_json(t) for t in texts], columns=["json", "reason"], dtype=object)


# The function is deterministic; it is flagged otherwise only as a planner
# barrier: predicates over parsed values (e.g. "row has no reject reason")
# must not be inlined below the parse, which would plan a second Python pass.
literal_to_json = _literal_to_json.asNondeterministic()
literal_to_json.__doc__ = "Python-literal list of dicts -> (JSON text, NULL); anything else -> (NULL, reason)."


def has_null_element(arr: Column) -> Column:
    """True when the array holds a NULL element.  ``sort_array`` puts NULL
    elements first; unlike ``exists(arr, x -> x IS NULL)`` this keeps the
    projection inside whole-stage codegen (lambdas force interpretation)."""
    return (F.size(arr) > 0) & F.try_element_at(F.sort_array(arr), F.lit(1)).isNull()


def _marked(text: Column) -> Column:
    """The text with its plain elements as JSON between marks."""
    return F.regexp_replace(text, _ELEMENT, _ELEMENT_JSON)


def _is_plain(text: Column, marked: Column) -> Column:
    rest = F.translate(F.regexp_replace(marked, f"{_MARK}[^{_MARK}]*+{_MARK}", _MARK), " \t\r\n", "")
    return ~text.contains(_MARK) & ((rest == "[]") | (F.replace(rest, F.lit(_MARK + ","), F.lit("")) == f"[{_MARK}]"))


def _plain_json(marked: Column) -> Column:
    """The JSON text of a plain list: its elements' names hold nothing that
    JSON escapes."""
    return F.when(marked.contains(_MARK), F.replace(F.btrim(marked, F.lit(" \t\r\n")), F.lit(_MARK), F.lit(""))).otherwise(F.lit("[]"))


def is_plain_list(text: Column) -> Column:
    """Whether the text is a list of plain ``id``/``name`` elements and nothing
    else."""
    return _is_plain(text, _marked(text))


# Tokens of a literal: strings, marks, words, numbers.
_TOKEN = (r"""'[^'\\\p{Cntrl}]*+(?:\\[^\p{Cntrl}][^'\\\p{Cntrl}]*+)*+'|"[^"\\\p{Cntrl}]*+(?:\\[^\p{Cntrl}][^"\\\p{Cntrl}]*+)*+\""""
          r"""|[\[\]{},:]|None\b|True\b|False\b|-?[0-9][0-9.]*+(?![\w.])""")
# Numbers whose Python and JSON text is the literal's: integers that Python reads, and decimals of up to 15 digits
# that need no exponent.
_NUMBER = (r"-?(?:0|[1-9][0-9]{0,4299})(?<!-0)"
           r"|(?=-?[0-9.]{3,16}$)-?(?:0\.(?!0000)|[1-9][0-9]*\.)(?:0|[0-9]*[1-9])")
# Escapes that this grammar leaves to Python: control characters, octal, names, surrogates, and those cut short.
_OTHER_ESCAPE = r"\\(?:[av0-7NU]|x(?![2-9a-fA-F][0-9a-fA-F])|u(?![0-9a-fA-F]{4})|u00[01]|u[dD][89a-fA-F])"
_WORDS = {"None": "null", "True": "true", "False": "false"}
# How a list of dicts begins.
_OPENING = r"^[ \t\r\n]*+\[[ \t\r\n]*+[{\]]"
#: Longer texts, and texts with more backslashes, go to Python: patterns take a step of stack for each escape.
FLAT_MAX_CHARS, FLAT_MAX_ESCAPES = 100_000, 500
_SLASH, _QUOTE, _KEY, _PAIR, _END = "\x01", "\x02", "\x03", "\x04", "\x05"


def _string_to_json(token: Column) -> Column:
    """A Python string token without control characters or escapes of
    ``_OTHER_ESCAPE`` as JSON text."""
    inner = token.substr(F.lit(2), F.length(token) - 2)
    for old, new in ((r"\\", _SLASH), (r"\'", "'"), (r'\"', _QUOTE), ('"', _QUOTE)):
        inner = F.replace(inner, F.lit(old), F.lit(new))
    inner = F.regexp_replace(inner, r"\\([^bfnrtxu])", _SLASH + "$1")  # an escape that means nothing is a backslash
    inner = F.regexp_replace(inner, r"\\x([0-9a-fA-F]{2})", r"\\u00$1")
    coded = inner.contains("\\u")
    inner = F.replace(F.replace(inner, F.lit(_SLASH), F.lit(r"\\")), F.lit(_QUOTE), F.lit(r'\"'))
    plain = F.concat(F.lit('"'), inner, F.lit('"'))
    # letters in place of their codes: read as JSON and written again
    read = F.from_json(F.concat(F.lit("["), plain, F.lit("]")), "array<string>")
    written = F.to_json(read)
    return F.when(coded, written.substr(F.lit(2), F.length(written) - 2)).otherwise(plain)


def flat_lists(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """For each ``text column: output column``, the canonical JSON of the texts
    that are lists of flat dicts, else NULL.

    The text must be tokens and white space and nothing else; with its tokens
    as letters, pairs, dicts and the list are taken together one after another
    until only a list is left.  Keys must be plain and different.
    """
    for text, out in columns.items():
        t, tokens, ok = F.col(text), F.col(f"__k_{out}"), F.col(f"__v_{out}")
        fits = t.rlike(_OPENING) & (F.length(t) <= FLAT_MAX_CHARS) & (F.length(t) - F.length(F.replace(t, F.lit("\\"), F.lit(""))) <= FLAT_MAX_ESCAPES)
        df = df.withColumn(f"__t_{out}", F.when(fits, t))
        t = F.col(f"__t_{out}")
        df = df.withColumn(f"__k_{out}", F.regexp_extract_all(t, F.lit(f"({_TOKEN})"), F.lit(1)))
        shape = F.array_join(F.transform(tokens, lambda x: F.when(x.rlike("^['\"]"), F.lit("S")).when(x.rlike("^[-NTF0-9]"), F.lit("N"))
                                         .otherwise(x)), "")
        for pattern, letter in ((r"S:[SN]", "P"), (r"P,(?=P)", ""), (r"\{P?\}", "E"), (r"E,(?=E)", "")):
            shape = F.regexp_replace(shape, pattern, letter)
        rest = F.regexp_replace(F.regexp_replace(t, _TOKEN, ""), r"[ \t\r\n]+", "")
        good = F.forall(tokens, lambda x: ~F.replace(x, F.lit(r"\\"), F.lit(_SLASH)).rlike(_OTHER_ESCAPE) & (~x.rlike("^[-0-9]") | x.rlike(f"^(?:{_NUMBER})$")))
        df = df.withColumn(f"__v_{out}", (rest == "") & shape.isin("[E]", "[]") & good)
        marks = {"[": "", "]": "", "{": "", "}": _END, ":": _KEY, ",": _PAIR}

        def token_to_json(x: Column) -> Column:
            to = F.when(x.rlike("^['\"]"), F.when(x.contains("\\") | x.contains('"'), _string_to_json(x))
                        .otherwise(F.concat(F.lit('"'), x.substr(F.lit(2), F.length(x) - 2), F.lit('"'))))
            for old, new in (marks | _WORDS).items():
                to = to.when(x == old, F.lit(new))
            return to.otherwise(x)

        joined = F.array_join(F.transform(F.when(ok, tokens), token_to_json), "")
        df = df.withColumn(f"__p_{out}", F.split(joined, _END, -1))
        parts = F.col(f"__p_{out}")
        df = df.withColumn(f"__d_{out}", F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), lambda pairs: F.array_sort(
            F.filter(F.split(pairs, _PAIR, -1), lambda p: p != ""))))
        d = F.col(f"__d_{out}")

        def keys(pairs: Column) -> Column:
            return F.transform(pairs, lambda p: F.substring_index(p, _KEY, 1))

        # keys are sorted with their closing quotes: letters below a quote in a key would sort otherwise
        plain = F.forall(d, lambda pairs: (F.size(F.array_distinct(keys(pairs))) == F.size(pairs))
                         & F.forall(keys(pairs), lambda k: ~k.substr(F.lit(2), F.length(k) - 2).rlike(r'[ !"\\]')))
        text_of = F.concat(F.lit("["), F.array_join(F.transform(d, lambda pairs: F.concat(
            F.lit("{"), F.replace(F.array_join(pairs, ","), F.lit(_KEY), F.lit(":")), F.lit("}"))), ","), F.lit("]"))
        df = df.withColumn(out, F.when(plain, text_of)).drop(*[f"__{x}_{out}" for x in "tkvpd"])
    return df


def with_json_lists(df: DataFrame, specs: list[tuple[Column, str, str, str]]) -> DataFrame:
    """Add canonical list texts to ``df`` in narrow projections.

    ``specs``: ``(text column, output name, default text, reject label)``.
    Adds ``<name>`` (canonical JSON text, NULL if rejected) and
    ``<name>__reason``.  The Arrow UDF sees only texts that need it.
    """
    n = range(len(specs))
    df = df.withColumns({f"__jt{i}": F.coalesce(c, F.lit(default)) for i, (c, _, default, _) in enumerate(specs)})
    df = df.withColumns({f"__jm{i}": _marked(F.col(f"__jt{i}")) for i in n})
    df = df.withColumns({f"__jo{i}": _is_plain(F.col(f"__jt{i}"), F.col(f"__jm{i}")) for i in n})
    df = df.withColumns({f"__jf{i}": F.when(F.col(f"__jo{i}"), _plain_json(F.col(f"__jm{i}"))) for i in n})
    listed = {i: F.ltrim(F.col(f"__jt{i}")).startswith("[") for i in n}
    df = df.withColumns({f"__js{i}": F.when(~F.col(f"__jo{i}") & listed[i], F.col(f"__jt{i}")) for i in n})
    df = flat_lists(df, {f"__js{i}": f"__jg{i}" for i in n})
    df = df.withColumns({f"__ju{i}": literal_to_json(F.when(F.col(f"__jg{i}").isNull(), F.col(f"__js{i}"))) for i in n})
    out = {}
    for i, (_, name, _, label) in enumerate(specs):
        ok, read, slow = F.col(f"__jo{i}"), F.col(f"__jg{i}"), F.col(f"__ju{i}")
        out[name] = F.when(ok, F.col(f"__jf{i}")).otherwise(F.coalesce(read, slow["json"]))
        out[f"{name}__reason"] = (
            F.when(ok | read.isNotNull(), F.lit(None).cast("string"))
            .when(~listed[i], F.lit(f"{label}:not_a_list"))
            .when(slow["reason"].isNotNull(), F.concat(F.lit(f"{label}:"), slow["reason"])))
    helpers = [c for c in df.columns if c.startswith("__j")]
    return df.withColumns(out).drop(*helpers)
