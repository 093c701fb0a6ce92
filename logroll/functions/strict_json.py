"""Strict JSON on Spark's VARIANT type.

``try_parse_json`` stops after the first complete value and ignores what follows, so
``{"a":1} x`` would pass.  The message is therefore parsed as the first element of an array that
ends with a sentinel string on a new line: ``[<text>\n,"<sentinel>"]``.  It is exactly one JSON
value only if that array has two elements and the second is the sentinel — trailing text after
the value either breaks the parse, adds elements, or ends the array early (and the parser then
ignores the sentinel).  A string or escape left open by the text cannot swallow the sentinel,
because a raw newline is illegal inside a JSON string.  One parse per message.

The parser has limits of its own (numbers of 1,000 digits, strings of 20 million characters) that are no rule
of JSON.  A message it refuses is parsed once more with these limits raised, if it is long enough to have met
one and at most 40 MB, which no way of writing swells beyond what a VARIANT holds.  The limit of 1,000 levels stays:
reading a VARIANT goes down its levels by recursion, and at 1,500 a task's stack overflows, which ends the executor.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def decode_payload(value: Column) -> Column:
    """Message bytes → text; invalid UTF-8 sequences become U+FFFD, as a byte-to-string decode does."""
    return F.make_valid_utf8(value.cast("string"))


_SENTINEL = "\u0000end"


# Messages of this many bytes may have met a limit of the first parser; longer ones are not tried again.
_RETRY_BYTES = (1_000, 40_000_000)
_RETRY_LIMITS = {"maxNumLen": "40000000", "maxStringLen": "40000000"}


def parse_wrapped(text: Column) -> Column:
    """``[<text>\n,"<sentinel>"]`` as VARIANT (null if it is not JSON); messages beyond the first parser's
    limits are parsed again with higher ones."""
    wrapped = F.concat(F.lit("["), text, F.lit('\n,"\\u0000end"]'))
    again = F.when(F.octet_length(text).between(*_RETRY_BYTES), F.from_json(wrapped, "variant", _RETRY_LIMITS))
    return F.coalesce(F.try_parse_json(wrapped), again)


def strict_ok(wrapped: Column, text: Column) -> Column:
    """True only if the wrapped array of ``text`` is exactly ``[value, sentinel]``.  Never null.

    Behind a second element that is the sentinel a third one exists only if the text itself spells the
    sentinel, and JSON spells its first character in one way, ``\\u0000``.  Only then is the third looked
    up: a path that leads nowhere ends in an exception inside Spark, dearer than the whole parse."""
    return F.coalesce(
        (F.try_variant_get(wrapped, "$[1]", "string") == F.lit(_SENTINEL))
        & (~F.contains(text, F.lit("\\u0000")) | F.try_variant_get(wrapped, "$[2]", "variant").isNull()),
        F.lit(False),
    )


def strict_value(wrapped: Column) -> Column:
    return F.try_variant_get(wrapped, "$[0]", "variant")


def member_variants(wrapped: Column, names) -> Column:
    """Members of the value as a struct of VARIANTs, looked up in one pass.  An absent member is null (JSON null
    is a VARIANT of its own), and the struct is null if the value is no object."""
    return F.try_variant_get(wrapped, "$[0]", f"struct<{', '.join(f'`{n}`: variant' for n in names)}>")


def member_texts(text: Column, names) -> Column:
    """Members of an object, whose text is known to be strict JSON, as a struct of texts: a string's value, else the
    JSON text; null if absent.  Of a member given twice the last one counts, as in the VARIANT."""
    return F.from_json(text, ", ".join(f"`{n}` string" for n in names), _RETRY_LIMITS)


def parse_strict(text: Column) -> tuple[Column, Column]:
    """Return ``(ok, parsed)``: ``ok`` is true only for exactly one complete JSON value (with
    surrounding JSON whitespace); ``parsed`` is that value as VARIANT.  Never raises.  (Stage
    ``parse_wrapped`` as its own column when both are needed, so the text is parsed once.)"""
    wrapped = parse_wrapped(text)
    return strict_ok(wrapped, text), strict_value(wrapped)


def json_type(parsed: Column, field: str) -> Column:
    """Type name of member ``field``: STRING, BIGINT, DOUBLE, DECIMAL(p,s), BOOLEAN, VOID (JSON
    null), OBJECT<..>, ARRAY<..>; SQL NULL when the member is absent."""
    return F.schema_of_variant(F.try_variant_get(parsed, f"$.{field}", "variant"))


def is_number_type(type_name: Column) -> Column:
    return type_name.isin("BIGINT", "DOUBLE") | type_name.startswith("DECIMAL")


def starts_object(text: Column) -> Column:
    """First non-whitespace character is ``{`` (cheap root-type test on the raw text)."""
    return text.rlike(r"^[ \t\n\r]*\{")
