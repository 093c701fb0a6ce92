"""Personal data replaced by keyed surrogates.  DataFrame functions only.

Detected: e-mail addresses, phone and card numbers (by check digit), IPv4 addresses, US social
security numbers, IBANs, access keys, values of password/token/secret assignments, and names after
a title.  A surrogate is drawn from a keyed digest of the entity and keeps type and format: the
punctuation of each mention, country codes, valid card check digits, hexadecimal secrets, and for
names the gender told by the title and the script.

*Coreference*: one entity (its canonical form: digits of a number, lower-cased address, ...) has
one surrogate in all documents.  *Distinctness*: the table of distinct entities is checked; a
surrogate shared by two entities, or equal to an entity of the corpus, is drawn again with the next
attempt number.  From ``GROW`` attempts on addresses, secrets and names get a keyed label that grows
with the attempt, so their space is never too small.  Types of a fixed format (numbers, keys) whose
space is full or nearly full end in a keyed token, ``[ssn-<digest>]``, which is distinct by itself.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from logroll.llm.common import freeze

# Detection patterns, one per type, tried in this order at a position.
_TITLES_M = "Mr|Herr|Monsieur|Señor|Sr|г-н"
_TITLES_F = "Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Sra|г-жа"
# A group of a run of digits: not glued to a letter, nor the start of an address of either sort.
_GROUP = r"(?:\d{4,}+(?![\p{L}\p{N}])|\d{1,3}+(?![\p{L}\p{N}]|\.\d))(?![\p{L}\p{N}._%+-]{0,63}@)"
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}])[\p{L}\p{N}_][\p{L}\p{N}._%+-]{0,63}@(?:[\p{L}\p{N}](?:[\p{L}\p{N}-]{0,61}[\p{L}\p{N}])?\.){1,8}\p{L}{2,24}",
    "ip": r"(?<![\p{L}\p{N}.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?![\p{L}\p{N}]|\.\d)",
    "card": rf"(?<![\p{{L}}\p{{N}}+-])(?=\d(?:[ -]?\d){{12}}){_GROUP}(?:[ -]{_GROUP})*+",      # cut up by _run_parts
    "ssn": r"(?<![\p{L}\p{N}-])\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}]|-\d)",
    "phone": r"(?<![\p{L}\p{N}])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}|\(\d{3}\) ?\d{3}-\d{4}|\d{3}[-.]\d{3}[-.]\d{4})(?![\p{L}\p{N}])",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z]{4})?(?: ?\d{4}){2,7}(?: ?\d{1,3})?(?![\p{L}\p{N}])",
    "key": r"(?<![\p{L}\p{N}])(?:AKIA|ASIA)[A-Z0-9]{16}(?![\p{L}\p{N}])",
    "secret": r"(?<![\p{L}\p{N}])(?i:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)[ \t]{0,3}[=:][ \t]{0,3}[\"']?[A-Za-z0-9+/_.~-]{6,}",
    "person": rf"(?<![\p{{L}}\p{{N}}])(?:{_TITLES_M}|{_TITLES_F})\.? \p{{Lu}}\p{{Ll}}{{1,30}}(?: \p{{Lu}}\p{{Ll}}{{1,30}})?",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
_VALUE = r"[A-Za-z0-9+/_.~-]{6,}$"
MAX_ATTEMPTS, GROW = 40, 2

_LATIN, _CYRILLIC = "abcdefghijklmnopqrstuvwxyz", "абвгдежзиклмнопрстуфхцчшэюя"
#: Letters without case, by script; letters of any script not listed become Latin ones.
_CASELESS = {"Han": "安白成达恩方高海江凯林明宁平青荣山天文新", "Hiragana": "あいうえおかきくけこさしすせそたちつてと",
             "Katakana": "アイウエオカキクケコサシスセソタチツテト", "Hangul": "가나다라마바사아자차카타파하",
             "Arabic": "ابتثجحخدرزسشصطعغفقكلمنهوي", "Hebrew": "אבגדהוזחטיכלמנסעפצקרשת",
             "Devanagari": "कखगघचछजझटठडढतथदधनपफबभमयरलवशसह", "Thai": "กขคงจฉชซดตถทนบปผพมยรลวสห"}


def _whole(kind: str) -> str:
    """A pattern for a mention on its own (no surroundings to look at)."""
    body = PATTERNS[kind]
    body = body[body.index(")") + 1:]
    end = body.rfind("(?!")
    return "^(?:" + (body[:end] if end > 0 else body) + ")$"


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, r"[^0-9]", "")


def _luhn_sum(digits: Column, upto: Column) -> Column:
    """Luhn total of digits[0:upto], counted so that the last digit of the number is not doubled."""
    chars = F.split(digits, "")
    n = F.length(digits)
    return F.aggregate(F.sequence(F.lit(1), upto), F.lit(0), lambda acc, i: acc + (
        lambda d: F.when((n - i) % 2 == 1, F.when(d > 4, d * 2 - 9).otherwise(d * 2)).otherwise(d))(
            F.element_at(chars, i).cast("int")))


def kind_of(mention: Column) -> Column:
    """Type of a mention that is no run of digits."""
    out = F.lit(None).cast("string")
    for kind in reversed([k for k in PATTERNS if k != "card"]):
        out = F.when(mention.rlike(_whole(kind)), kind).otherwise(out)
    return out


_PART = "array<struct<said:string,kind:string>>"


def _part(said: Column, kind: Column) -> Column:
    return F.struct(said.alias("said"), kind.cast("string").alias("kind"))


def _run_parts(run: Column) -> Column:
    """A run of digit groups, cut into cards and other text (kind null), nothing left out.

    From the first group on, the longest 13 to 19 digits that end at a separator and have a valid
    check digit are a card; if there are none the search goes on from the next group.  Cards are
    printed with a first group of four digits or more; a run that starts otherwise is a card as a
    whole, or by a prefix if all its groups are short.  What is left is searched for other numbers.
    """
    lens, digits = F.transform(F.split(run, "[ -]"), F.length), _digits(run)
    at = F.aggregate(lens, F.array(F.lit(0)), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))

    def cut(lens, digits, at):
        count = F.size(lens)

        def step(acc, i):
            first = F.element_at(at, i + 1)
            size = lambda e: F.element_at(at, e + 1) - first
            valid = lambda e: F.when(size(e).between(13, 19), _luhn_sum(
                F.substr(digits, first + 1, size(e)), size(e)) % 10 == 0).otherwise(F.lit(False))
            printed = F.element_at(lens, i + 1) >= 4
            ends = F.when((i == 0) | printed, F.array_max(F.filter(F.sequence(i + 1, F.least(i + 19, count)), lambda e: (
                printed | (e == count) | ~F.exists(lens, lambda n: n >= 4)) & valid(e))))
            ahead = F.concat(acc["rest"], F.when(i > 0, F.substr(run, first + i, F.lit(1))).otherwise(F.lit("")))

            def taken(end):
                card = F.substr(run, first + i + 1, size(end) + end - i - 1)
                return F.when(end.isNotNull(), F.struct(end.alias("next"), F.lit("").alias("rest"), F.concat(
                    acc["parts"], F.array(_part(ahead, F.lit(None)), _part(card, F.lit("card")))).alias("parts"))).otherwise(
                        F.struct(acc["next"].alias("next"), F.concat(ahead, F.substr(
                            run, first + i + 1, F.element_at(lens, i + 1))).alias("rest"), acc["parts"].alias("parts")))
            return F.when(i < acc["next"], acc).otherwise(F.element_at(F.transform(F.array(ends), taken), 1))

        start = F.struct(F.lit(0).alias("next"), F.lit("").alias("rest"), F.array().cast(_PART).alias("parts"))
        return F.aggregate(F.sequence(F.lit(0), count - 1), start, step, lambda acc: F.concat(
            acc["parts"], F.array(_part(acc["rest"], F.lit(None)))))

    bound = F.transform(F.array(F.struct(lens.alias("lens"), digits.alias("digits"), at.alias("at"))),
                        lambda x: cut(x["lens"], x["digits"], x["at"]))
    other = "|".join(f"(?:{PATTERNS[k]})" for k in ("ssn", "phone"))
    found = lambda said: F.flatten(F.zip_with(
        F.split(said, other, -1), F.regexp_extract_all(said, F.lit(other), F.lit(0)),
        lambda gap, m: F.array(_part(gap, F.lit(None)), _part(F.coalesce(m, F.lit("")), F.when(m != "", kind_of(m))))))
    return F.flatten(F.transform(F.element_at(bound, 1), lambda p: F.when(
        p["kind"].isNull(), found(p["said"])).otherwise(F.array(p))))


def parts_of(mention: Column) -> Column:
    """(said, kind) of the parts of a mention: one, but for runs of digits."""
    run = mention.rlike(r"^\d[\d -]*$") & (F.length(_digits(mention)) >= 13)
    return F.when(run, _run_parts(mention)).otherwise(F.array(_part(mention, kind_of(mention))))


def _words(mention: Column) -> Column:
    """Name words of a person mention (its title left out)."""
    return F.split(F.regexp_replace(mention, r"^\S+ ", ""), " ")


def _gender(mention: Column) -> Column:
    return F.when(mention.rlike(rf"^(?:{_TITLES_F})\b"), "f").otherwise("m")


def keys_of(kind: Column, mention: Column) -> Column:
    """Canonical entities of a mention: 'type|canonical', two for a name with given and family name."""
    words = _words(mention)
    names = F.transform(words, lambda w, i: F.concat(
        F.when(i + 1 < F.size(words), "given_").otherwise("family_"), _gender(mention), F.lit("|"), F.lower(w)))
    one = (F.when(kind.isin("card", "ssn"), _digits(mention))
           .when(kind == "phone", F.concat(F.when(mention.startswith("+"), F.regexp_extract(mention, r"^\+\d{1,3}", 0))
                                           .otherwise(""), F.lit(":"), _digits(mention)))
           .when(kind == "iban", F.replace(mention, F.lit(" "), F.lit("")))
           .when(kind == "email", F.lower(mention))
           .when(kind == "secret", F.regexp_extract(mention, _VALUE, 0))
           .otherwise(mention))
    return F.when(kind == "person", names).otherwise(F.array(F.concat(kind, F.lit("|"), one)))


def _stream(key: str, entity: Column, attempt: Column) -> Column:
    """256 hexadecimal digits drawn from the keyed entity."""
    seed = F.concat(F.lit(key + "|"), entity, F.lit("|"), attempt.cast("string"))
    return F.concat(F.sha2(F.concat(seed, F.lit("#0")), 512), F.sha2(F.concat(seed, F.lit("#1")), 512))


def _byte(stream: Column, i: Column) -> Column:
    return F.conv(F.substr(stream, (i % 128) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _pick(alphabet: str, b: Column) -> Column:
    return F.substr(F.lit(alphabet), b % len(alphabet) + 1, F.lit(1))


def _shaped(value: Column, stream: Column, hexadecimal: Column) -> Column:
    """Each digit and letter replaced by one of its class (script and case kept), the rest as it is."""
    def swap(c, i):
        b = _byte(stream, i)
        return (F.when(hexadecimal & c.rlike("[0-9a-f]"), _pick("0123456789abcdef", b))
                .when(c.rlike("[0-9]"), (b % 10).cast("string"))
                .when(c.rlike("[a-z]"), _pick(_LATIN, b)).when(c.rlike("[A-Z]"), F.upper(_pick(_LATIN, b)))
                .when(c.rlike(r"\p{IsCyrillic}") & (F.lower(c) == c), _pick(_CYRILLIC, b))
                .when(c.rlike(r"\p{IsCyrillic}"), F.upper(_pick(_CYRILLIC, b)))
                .when(c.rlike(r"\p{Ll}"), _pick("àâçèéêëîïôöùûüñ", b)).when(c.rlike(r"\p{Lu}"), _pick("ÀÂÇÈÉÊËÎÏÔÖÙÛÜÑ", b))
                .otherwise(reduce(lambda out, script: F.when(c.rlike(rf"\p{{Is{script}}}"), _pick(_CASELESS[script], b))
                                  .otherwise(out), _CASELESS, F.when(c.rlike(r"\p{L}"), _pick(_LATIN, b))
                                  .when(c.rlike(r"\p{N}"), (b % 10).cast("string")).otherwise(c))))
    return F.array_join(F.transform(F.split(value, ""), swap), "")


def _label(stream: Column, attempt: Column) -> Column:
    """Letters that widen the space of a type without a fixed length: none before GROW, then two more an attempt."""
    letters = F.transform(F.sequence(F.lit(0), (attempt - GROW) * 2 + 1), lambda i: _pick(_LATIN, _byte(stream, i + 64)))
    return F.when(attempt < GROW, F.lit("")).otherwise(F.array_join(letters, ""))


def _fallback(key: str, entity: Column) -> Column:
    """A token no other entity has (128 bits of the keyed digest) and no text of the type equals."""
    kind = F.regexp_replace(F.substring_index(entity, "|", 1), "^(?:given|family)_.$", "name")
    return F.concat(F.lit("["), kind, F.lit("-"), F.substr(_stream(key, entity, F.lit("end")), F.lit(1), F.lit(32)), F.lit("]"))


def _name(canon: Column, kind: Column, stream: Column, more: Column) -> Column:
    """An invented name in the entity's script, ending by gender: two or three syllables and ``more``."""
    cyr = canon.rlike(r"\p{IsCyrillic}")

    def syllables(consonants, vowels):
        def one(i):
            return F.concat(_pick(consonants, _byte(stream, i * 2)), _pick(vowels, _byte(stream, i * 2 + 1)))
        return F.array_join(F.transform(F.sequence(F.lit(0), 2 + _byte(stream, F.lit(100)) % 2 + more), one), "")

    ending = lambda m, f, fam: F.when(kind == "given_f", f).when(kind == "given_m", m).when(
        kind == "family_f", fam[1]).otherwise(fam[0])
    latin = F.concat(syllables("bdfgklmnprstv", "aeiou"), ending("n", "lla", ("son", "son")))
    cyril = F.concat(syllables("бвгдклмнпрст", "аеиоу"), ending("н", "лла", ("ров", "рова")))
    return F.initcap(F.when(cyr, cyril).otherwise(latin))


def surrogate(key: str, entity: Column, attempt: Column) -> Column:
    """Surrogate (canonical form) of an entity 'type|canonical'."""
    kind, canon = F.substring_index(entity, "|", 1), F.expr("substring(entity, instr(entity, '|') + 1)")
    stream = _stream(key, entity, attempt)
    b = lambda i: _byte(stream, F.lit(i))
    no = F.lit(False)
    said, label = F.substring_index(canon, "@", 1), _label(stream, attempt)
    local = F.concat(F.when(said.rlike(r"[\p{L}\p{N}]"), _shaped(said, stream, no))
                     .otherwise(F.concat(*[_pick(_LATIN, b(i)) for i in range(4)])), label)
    domain = F.substring_index(canon, "@", -1)
    ahead = F.regexp_extract(domain, r"^((?:[^.]+\.)*)[^.]+\.[^.]+$", 1)
    email = F.concat(local, F.lit("@"), _shaped(ahead, F.reverse(stream), no), F.lit("example."),
                     F.substring_index(domain, ".", -1))
    first = F.when(attempt < 4, F.lit("10")).otherwise((240 + b(3) % 15).cast("string"))
    ip = F.concat_ws(".", first, b(0).cast("string"), b(1).cast("string"), b(2).cast("string"))
    swapped = _shaped(canon, stream, no)
    hexa = canon.rlike("^[0-9a-f]+$")
    body = F.concat(F.substr(canon, F.lit(1), F.lit(1)), F.substr(swapped, F.lit(2), F.length(canon) - 2))
    total = _luhn_sum(F.concat(body, F.lit("0")), F.length(body))
    card = F.concat(body, ((10 - total % 10) % 10).cast("string"))
    cc = F.substring_index(canon, ":", 1)
    number = F.substring_index(canon, ":", -1)
    kept = F.greatest(F.length(cc) - 1, F.lit(0))
    phone = F.concat(F.substr(number, F.lit(1), kept), (2 + b(100) % 8).cast("string"),
                     F.substr(_shaped(number, stream, no), kept + 2, F.length(number)))
    return (F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "card", card).when(kind == "phone", phone)
            .when(kind == "ssn", F.concat(F.lit("9"), F.substr(swapped, F.lit(2), F.lit(8))))
            .when(kind == "iban", F.concat(F.substr(canon, F.lit(1), F.lit(2)), F.substr(swapped, F.lit(3), F.length(canon))))
            .when(kind == "key", F.concat(F.substr(canon, F.lit(1), F.lit(4)), F.substr(swapped, F.lit(5), F.lit(16))))
            .when(kind == "secret", F.concat(_shaped(canon, stream, hexa), F.when(hexa, F.translate(
                label, "ghijklmnopqrstuvwxyz", "abcdefabcdefabcdefab")).otherwise(label)))
            .otherwise(_name(canon, kind, stream, F.greatest(attempt - GROW + 1, F.lit(0)))))


def own_form(entity: Column) -> Column:
    """The canonical form a surrogate must not equal."""
    kind, canon = F.substring_index(entity, "|", 1), F.expr("substring(entity, instr(entity, '|') + 1)")
    return F.when(kind == "phone", F.substring_index(canon, ":", -1)).when(
        kind.rlike("^(given|family)_"), F.initcap(canon)).otherwise(canon)


def assign(entities: DataFrame, key: str) -> DataFrame:
    """(entity, surrogate) for distinct ``entities``, unique within a type and unlike any entity."""
    kind = F.substring_index("entity", "|", 1)
    kind = F.when(kind.rlike("^(given|family)_"), "name").otherwise(kind).alias("kind")
    real = freeze(entities.select("entity", kind, own_form(F.col("entity")).alias("own")), "pii-real")
    now = freeze(real.select("entity", "kind", F.lit(0).alias("attempt"))
                 .withColumn("s", surrogate(key, F.col("entity"), F.col("attempt"))), "pii-0")
    taken = real.select("kind", F.col("own").alias("s")).distinct()
    for i in range(1, MAX_ATTEMPTS + 1):
        first = now.groupBy("kind", "s").agg(F.min(F.struct("attempt", "entity"))["entity"].alias("first"),
                                             F.count(F.lit(1)).alias("n"))
        clash = first.where("n > 1").select("kind", "s", "first").union(
            first.join(taken, ["kind", "s"], "left_semi").select("kind", "s", F.lit(None).cast("string")))
        bad = freeze(now.join(clash.groupBy("kind", "s").agg(F.min("first").alias("first"), F.count(F.lit(1)).alias("c"),
                                                            F.max(F.col("first").isNull()).alias("real")), ["kind", "s"])
                     .where(F.col("real") | (F.col("entity") != F.col("first"))).select("entity"), f"pii-clash{i}")
        if not bad.limit(1).count():
            return now.select("entity", F.col("s").alias("surrogate"))
        again = bad.withColumn("redo", F.lit(True))
        attempt = F.when(F.col("redo"), F.lit(i)).otherwise(F.col("attempt"))
        drawn = surrogate(key, F.col("entity"), F.lit(i)) if i < MAX_ATTEMPTS else _fallback(key, F.col("entity"))
        now = freeze(now.join(again, "entity", "left").select("entity", "kind", attempt.alias("attempt"), F.when(
            F.col("redo"), drawn).otherwise(F.col("s")).alias("s")), f"pii-{i}")
    return now.select("entity", F.col("s").alias("surrogate"))


def _in_format(mention: Column, digits: Column) -> Column:
    """``digits`` in the punctuation of ``mention``."""
    chars = F.split(mention, "")
    step = lambda acc, c: F.when(c.rlike("[0-9]"), F.struct(
        F.concat(acc["s"], F.substr(digits, acc["k"], F.lit(1))).alias("s"), (acc["k"] + 1).alias("k"))).otherwise(
            F.struct(F.concat(acc["s"], c).alias("s"), acc["k"].alias("k")))
    return F.aggregate(chars, F.struct(F.lit("").alias("s"), F.lit(1).alias("k")), step, lambda acc: acc["s"])


def _grouped(mention: Column, value: Column) -> Column:
    """An IBAN's characters with the blanks of the mention."""
    chars = F.split(mention, "")
    step = lambda acc, c: F.when(c == " ", F.struct(F.concat(acc["s"], c).alias("s"), acc["k"].alias("k"))).otherwise(
        F.struct(F.concat(acc["s"], F.substr(value, acc["k"], F.lit(1))).alias("s"), (acc["k"] + 1).alias("k")))
    return F.aggregate(chars, F.struct(F.lit("").alias("s"), F.lit(1).alias("k")), step, lambda acc: acc["s"])


def _rendered(m: Column, found: Column) -> Column:
    """The replacement of a mention from its entities' surrogates."""
    one = F.element_at(found, F.element_at(m["keys"], 1))
    names = F.array_join(F.transform(m["keys"], lambda k: F.element_at(found, k)), " ")
    said = m["said"]
    return (F.when(m["kind"].isNull(), said)
            .when(m["kind"] == "person", F.concat(F.regexp_extract(said, r"^\S+ ", 0), names))
            .when((m["kind"] != "secret") & one.rlike(r"^\[[a-z]+-[0-9a-f]{32}\]$"), one)
            .when(m["kind"].isin("card", "ssn", "phone"), _in_format(said, one))
            .when(m["kind"] == "iban", _grouped(said, one))
            .when(m["kind"] == "secret", F.concat(F.regexp_replace(said, _VALUE, ""), one))
            .otherwise(one))


def replace_personal_data(docs: DataFrame, key: str = "rotate-me", count: str | None = "n_entities") -> DataFrame:
    """``docs`` (all columns) with personal data in ``text`` replaced, and the mentions as ``count``.

    With None there is no such column; where ``docs`` has one of that name (in any case), its own
    column stays as it is and the mentions get the name with underscores added until it is free.
    ``n_chars``, where it exists, is counted anew for changed texts.  Null and empty texts and
    texts without a mention pass unchanged with 0; repeated rows change alike; no row is dropped.
    ``key`` decides all surrogates: reruns agree, another key gives others.
    """
    # Numbers that only look like cards are found by the pattern too and pass as they are.  A match
    # (found again by the same pattern as the gaps around it) is an array of parts.
    taken = {c.lower() for c in docs.columns}
    while count is not None and count.lower() in taken:
        count += "_"
    columns = [*docs.columns, *([count] if count else [])]
    has = F.coalesce(F.col("text").rlike(ANY), F.lit(False))
    mentions = F.transform(F.regexp_extract_all("text", F.lit(ANY), F.lit(0)), parts_of)
    keyed = F.transform("__m", lambda parts: F.transform(parts, lambda m: F.struct(
        m["said"].alias("said"), m["kind"].alias("kind"), F.when(m["kind"].isNotNull(), keys_of(
            m["kind"], m["said"])).otherwise(F.array().cast("array<string>")).alias("keys"))))
    hits = freeze(docs.where(has).withColumn("__m", mentions).withColumn("__m", keyed)
                  .withColumn("__row", F.monotonically_increasing_id()), "pii-hits")
    uses = hits.select("__row", F.explode(F.array_distinct(F.flatten(F.transform(F.flatten("__m"), lambda m: m["keys"])))).alias("entity"))
    told = assign(uses.select("entity").distinct(), key)
    found = (uses.join(told, "entity").groupBy("__row")
             .agg(F.map_from_entries(F.collect_list(F.struct("entity", "surrogate"))).alias("__found")))
    none = F.create_map().cast("map<string,string>")
    gaps = F.split("text", ANY, -1)
    new = F.array_join(F.zip_with(gaps, F.transform("__m", lambda parts: F.array_join(F.transform(
        parts, lambda m: _rendered(m, F.coalesce("__found", none))), "")), lambda g, r: F.concat(g, F.coalesce(r, F.lit("")))), "")
    out = hits.join(found, "__row", "left").withColumn("text", new)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    rest = docs.where(~has)
    if count:
        out = out.withColumn(count, F.size(F.filter(F.flatten("__m"), lambda m: m["kind"].isNotNull())).cast("long"))
        rest = rest.withColumn(count, F.lit(0).cast("long"))
    return rest.select(*columns).union(out.select(*columns))
