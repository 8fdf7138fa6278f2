"""Surrogates for personal data and secrets, in DataFrame operations only.

Detected entities are e-mail addresses, telephone numbers, payment cards (with a
valid check digit), IBANs, social security numbers, IPv4 addresses, access keys,
values of passwords and tokens, and names after a title.  Each gets a replacement
of its own type that a keyed digest of its canonical form decides: an address
stays an address, a card keeps a valid check digit, digits and letters keep their
places, case and script (a social security number and a secret of digits only keep
digits, a name in Chinese characters gets Chinese characters).  Of a name, the family name (with its particles) and each
given name or initial are entities of their own, so short and full forms agree under
any title; a given name keeps the gender of its title, and under a title without one
has the gender that the corpus gives it elsewhere, if only one does.

The canonical form leaves out how an entity is written (case of an address,
punctuation of a number), so all mentions of one entity get the same surrogate,
each written its own way.  Different entities get different surrogates, none of
which is a real entity of the corpus (given names and initials may be): the distinct entities are checked against
each other and losers draw again, with the number of the draw in the digest, until
none is left.  The names to draw from grow with the number of the draw, without end.
The documents that mention a redrawn entity carry its draw.

A password or token after its word is a secret if it is in quotes, follows ``=``
without a blank, or has a digit, both cases or a sign in it; a plain word after
"token:" or "secret =" is prose and stays.  Names are found after a title only.

Defined cases: null text stays null and has no entity; a text without entities
comes out as it is; rows that share an id are treated alike; an empty table is
empty; an entity of another kind whose length leaves it no free surrogate after
``DRAWS`` draws is blanked.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .store import column, settle

DRAWS = 24

# fixed values: titles by gender, and common given and family names
MALE_TITLES, FEMALE_TITLES, OTHER_TITLES = "Mr|Sir|Herr|Monsieur|Señor|Sr", "Mrs|Ms|Miss|Madam|Frau|Madame|Mademoiselle|Señora|Sra", "Dr|Prof"
MALE = "Adam Andre Anton Boris Carl Daniel David Emil Erik Felix Frank George Hugo Ivan Jack Jonas Karl Leon Louis Lucas Marco Martin Max Noah Oscar Otto Paul Peter Robert Simon Thomas Victor".split()
FEMALE = "Ada Alice Amelia Anna Clara Diana Elena Ella Emma Eva Flora Greta Hanna Helen Ida Irene Julia Karla Laura Lena Lucia Maria Marta Mia Nina Nora Olga Paula Rosa Sara Sofia Vera".split()
FAMILY = "Adler Baker Bauer Berger Blanc Brand Carter Castro Cooper Costa Dubois Fischer Fontana Garcia Graf Hansen Hunter Keller Lambert Lange Marin Mason Meyer Morel Navarro Palmer Petit Reyes Rossi Silva Turner Weber".split()

TITLES = f"{MALE_TITLES}|{FEMALE_TITLES}|{OTHER_TITLES}"
PARTICLES = "van|von|vom|der|den|de|del|della|di|da|dos|das|du|la|le|el|al|bin|ibn|bint|ter|ten|zu|zur|y"

BLANK = r"[ \t\u00A0]"
#: What stands before a name and before the value of a password or token.
TITLE = rf"(?:\b(?:{TITLES})\b(?:\.\s*|{BLANK}+))+"
SIGN = r"(?i:password|passwd|pwd|token|secret|api_key|apikey)(?:\\?[\"'])?\s*+[=:]\s*+(?:\\?[\"'])?"
#: A capitalised word with apostrophes and hyphens, or initials; names of scripts without capitals.
NAME_WORD = rf"(?!(?:{TITLES})\b)(?:(?:\p{{L}}{{1,2}}['’-])?\p{{Lu}}[\p{{L}}\p{{M}}]+(?:['’-](?!s\b)\p{{L}}[\p{{L}}\p{{M}}]*)*|(?:\p{{Lu}}\p{{M}}*\.-?)+|\p{{Lu}}(?={BLANK}+\p{{Lu}}\p{{L}}))"
CASELESS = rf"\p{{IsHan}}{{2,4}}|[\p{{Lo}}&&[^\p{{IsHan}}]][\p{{Lo}}\p{{M}}]*(?:{BLANK}+\p{{Lo}}[\p{{Lo}}\p{{M}}]*)?"
SUFFIX = rf"{BLANK}+(?:Jr|II|III|IV)"

OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
EMAIL = r"[A-Za-z0-9][A-Za-z0-9._%+-]*+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
ACCESS_KEY = r"\bAKIA[0-9A-Z]{16}\b"
#: Java patterns, the more specific first; each match is one entity with its kind.
PATTERNS = {
    "email": EMAIL,
    "key": ACCESS_KEY,
    "secret": rf"{SIGN}(?:{EMAIL}|{ACCESS_KEY}|[^\s\"'=:][^\s\"']{{5,}})",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b",
    "ip": rf"(?<![\d.])(?:{OCTET}\.){{3}}{OCTET}(?!\.?\d)",
    "phone": r"(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{2,4}\)|\d{2,4})(?:[ .-]?\d{2,4}){2,3}(?!\d)|(?<![\w(])(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[.-]\d{4}(?!\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "card": r"(?<![\d.])(?:\d[ -]?){12,18}\d(?!\d)",
    "name": rf"{TITLE}(?:(?:(?:{PARTICLES}){BLANK}+)*{NAME_WORD}(?:(?:{BLANK}+|(?<=\.))(?:(?:{PARTICLES}){BLANK}+)*{NAME_WORD})*|{CASELESS})",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: A quick look for anything that a pattern needs.
HINT = rf"[0-9@]|AKIA|(?i:passw|passwd|pwd|token|secret|api_?key)|\b(?:{TITLES})\b"
# fixed values: letters of the scripts in which letters are replaced by letters; for Chinese and Korean, signs that are usual in names
ALPHABETS = {
    "[0-9]": "0123456789",
    "[A-Z]": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "[a-z]": "abcdefghijklmnopqrstuvwxyz",
    "[\\u0410-\\u042F]": "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ",
    "[\\u0430-\\u044F]": "абвгдежзийклмнопрстуфхцчшщъыьэюя",
    "[\\u0391-\\u03A9]": "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ",
    "[\\u03B1-\\u03C9]": "αβγδεζηθικλμνξοπρστυφχψω",
    "[\\u05D0-\\u05EA]": "אבגדהוזחטיכלמנסעפצקרשת",
    "[\\u0621-\\u064A]": "ابتثجحخدذرزسشصضطظعغفقكلمنهوي",
    "[\\u0905-\\u0914]": "अआइईउऊएऐओऔ",
    "[\\u0915-\\u0939]": "कखगघचछजझटठडढतथदधनपफबभमयरलवशसह",
    "[\\u0E01-\\u0E2E]": "กขคงจฉชซญดตถทธนบปผพฟภมยรลวศสหอ",
    "[\\u3041-\\u3096]": "あいうえおかきくけこさしすせそたちつてとなにぬねのはひふへほまみむめもやゆよらりるれろわ",
    "[\\u30A1-\\u30FA]": "アイウエオカキクケコサシスセソタチツテトナニヌネノハヒフヘホマミムメモヤユヨラリルレロワ",
    "[\\u4E00-\\u9FFF]": "王李张刘陈杨赵黄周吴徐孙胡朱高林何郭马罗梁宋郑谢韩唐冯于董萧程曹袁邓许傅沈曾彭吕明华丽强军平杰敏静伟芳娜秀英磊洋勇艳涛超玲桂建国文",
    "[\\uAC00-\\uD7A3]": "김이박최정강조윤장임한오서신권황안송유홍민지수현영준성진호은주경",
}
HEX = "0123456789abcdef"
#: Names of these letters (and marks) only are replaced letter by letter.
LETTERWISE = "".join(p.strip("[]") for p in ALPHABETS if p not in ("[0-9]", "[A-Z]", "[a-z]"))


def _chars(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _check_sum(digits: Column, shift: int) -> Column:
    """Luhn sum of a string of digits; ``shift`` 1 if the check digit is still to come."""
    numbers = F.transform(F.reverse(_chars(digits)), lambda c: c.cast("int"))

    def weigh(n: Column, i: Column) -> Column:
        twice = F.when((i + shift) % 2 == 1, n * 2).otherwise(n)
        return F.when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.transform(numbers, weigh), F.lit(0), lambda a, n: a + n)


def _kind(value: Column, lead: Column) -> Column:
    """The kind of a match without its lead; null if it turns out to be none."""
    kind = F.lit("secret")
    for name in ("card", "ssn", "phone", "ip", "iban"):
        kind = F.when((lead == "") & value.rlike(f"^(?:{PATTERNS[name]})$"), F.lit(name)).otherwise(kind)
    for name in ("key", "email"):
        kind = F.when(value.rlike(f"^(?:{PATTERNS[name]})$"), F.lit(name)).otherwise(kind)
    kind = F.when(lead.rlike(f"^{TITLE}$"), F.lit("name")).otherwise(kind)
    # card numbers begin with 2 to 6 and end in a check digit
    valid = _digits(value).rlike("^[2-6][0-9]{12,18}$") & (_check_sum(_digits(value), 0) % 10 == 0)
    # a word of plain letters that the sign does not mark as a value is prose
    marked = lead.rlike(r"[\"']$|[A-Za-z]=$") | value.rlike(r"[0-9]|[a-z][A-Z]|[^\p{L}\p{M}'’.,;:!?()-]")
    return F.when((kind == "card") & ~valid | (kind == "secret") & ~marked, F.lit(None)).otherwise(kind)


def _canonical(kind: Column, value: Column) -> Column:
    family = rf"((?<![^ \t\u00A0.])(?:(?:{PARTICLES}){BLANK}+)*[^ \t\u00A0.]+\.?)$"
    return (
        F.when(kind == "email", F.lower(value))
        .when(kind.isin("phone", "ssn", "card"), _digits(value))
        .when(kind == "iban", F.replace(value, F.lit(" ")))
        .when(kind == "name", F.regexp_extract(F.regexp_replace(value, f"(?<=.){SUFFIX}$", ""), family, 1))
        .otherwise(value)
    )


def _gender(title: Column) -> Column:
    return F.when(title.rlike(rf"\b(?:{MALE_TITLES})\b"), "m").when(title.rlike(rf"\b(?:{FEMALE_TITLES})\b"), "f").otherwise("x")


INITIALS = r"^(?:\p{Lu}\p{M}*\.|\p{Lu})$"


def _given(m: Column) -> Column:
    """Of a name, what stands before the family name: given names and initials, particles and blanks, in order."""
    before = F.regexp_replace(m["value"], f"(?<=.){SUFFIX}$", "")
    before = F.substring(before, F.lit(1), F.length(before) - F.length(m["canonical"]))
    return F.regexp_extract_all(before, F.lit(r"[^ \t\u00A0.]+\.?|[ \t\u00A0.]+"), F.lit(0))


def _is_given(word: Column) -> Column:
    return ~word.rlike(rf"^(?:(?:{PARTICLES})|[ \t\u00A0.-]+)$")


def _given_name(m: Column, word: Column) -> Column:
    """The canonical form of a given name: gender and name; initials have no gender."""
    return F.concat(F.when(word.rlike(INITIALS), "i").otherwise(_gender(m["lead"])), F.lit(":"), word)


def _parts(m: Column) -> Column:
    """The entities of a match: kind and canonical form."""
    family = F.array(F.struct(F.when(m["kind"] == "name", "family").otherwise(m["kind"]).alias("kind"), m["canonical"].alias("canonical")))
    given = F.transform(F.filter(_given(m), _is_given), lambda w: F.struct(F.lit("given").alias("kind"), _given_name(m, w).alias("canonical")))
    return F.when(m["kind"] == "name", F.concat(family, given)).otherwise(family)


def _byte(digest: Column, i: Column) -> Column:
    """The i-th byte of a hex digest, starting over at its end."""
    return F.conv(F.substring(digest, F.pmod(i, F.lit(64)) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _range(pattern: str) -> tuple[Column, Column]:
    """First and last letter of a pattern of one range."""
    return tuple(F.lit(x.encode().decode("unicode_escape") if len(x) > 1 else x) for x in re.findall(r"\\u[0-9A-F]{4}|[^\[\]-]", pattern))


def _like(text: Column, digest: Column, hexadecimal: Column) -> Column:
    """Each digit and letter replaced by one of its own class, or by a hexadecimal digit; anything else stays."""

    def known(c: Column, i: Column) -> Column:
        letters = F.lit("")
        for pattern, of in ALPHABETS.items():
            letters = F.when(c.between(*_range(pattern)), F.lit(of)).otherwise(letters)
        letters = F.when(hexadecimal & c.between("0", "f"), F.lit(HEX)).otherwise(letters)
        return F.struct(c.alias("c"), letters.alias("letters"), _byte(digest, i).alias("byte"))

    def swap(x: Column) -> Column:
        pick = F.substring(x["letters"], x["byte"] % F.greatest(F.length(x["letters"]), F.lit(1)) + 1, F.lit(1))
        return F.when(x["letters"] == "", x["c"]).otherwise(pick)

    return F.array_join(F.transform(F.transform(_chars(text), known), swap), "")


def _pick(names: list[str], digest: Column, at: int) -> Column:
    # two bytes, so that all names are about equally likely
    number = _byte(digest, F.lit(at)) * 256 + _byte(digest, F.lit(at + 1))
    return F.element_at(F.array(*[F.lit(n) for n in names]), number % len(names) + 1)


def _made_up(digest: Column, syllables: Column) -> Column:
    """A name of so many syllables, an even number of them."""
    onsets = F.translate(F.substring(digest, F.lit(9), syllables), "0123456789abcdef", "bdfghjklmnprstvz")
    return F.initcap(F.regexp_replace(onsets, "(.)(.)", "$1a$2o"))


def _bound(use, **values: Column) -> Column:
    """``use`` of the values, each of which is worked out once."""
    one = F.struct(*[v.alias(n) for n, v in values.items()])
    return F.element_at(F.transform(F.array(one), lambda z: use(*[z[n] for n in values])), 1)


def _surrogate(kind: Column, canonical: Column, draw: Column, key: str) -> Column:
    """The canonical form of the replacement at a draw."""
    seed = F.concat_ws("\x1f", F.lit(key), kind, canonical, draw.cast("string"))
    digest = F.concat(F.sha2(seed, 256), F.sha2(F.concat(seed, F.lit("\x1f")), 256))
    return _bound(_drawn, kind=kind, canonical=canonical, draw=draw, digest=digest)


def _drawn(kind: Column, canonical: Column, draw: Column, digest: Column) -> Column:
    given = F.when(canonical.startswith("m:"), _pick(MALE, digest, 0)).when(canonical.startswith("f:"), _pick(FEMALE, digest, 0))
    listed = F.when(kind == "given", given.otherwise(_pick(MALE + FEMALE, digest, 0))).otherwise(_pick(FAMILY, digest, 2))
    # names of other scripts than the alphabets have get listed ones, as Latin names do
    name = F.when(kind == "given", F.substring(canonical, F.lit(3), F.length(canonical))).otherwise(canonical)
    name = F.translate(name, "ЁёΆΈΉΊΌΎΏάέήίόύώς", "ЕеΑΕΗΙΟΥΩαεηιουωσ")
    swapped = name.rlike(rf"^[{LETTERWISE}\p{{M}}'’ -]+$")
    # later draws double the name, then make up a longer one with every draw, so that names never run out
    second = F.when(kind == "given", _pick(MALE, digest, 4)).otherwise(_pick(FAMILY, digest, 4))
    second = F.when(canonical.startswith("f:"), _pick(FEMALE, digest, 4)).otherwise(second)
    listed = F.when(draw > 3, _made_up(digest, 2 * draw - 4)).when(draw > 1, F.concat(listed, F.lit("-"), second)).otherwise(listed)
    longer = F.concat(name, F.repeat(F.regexp_extract(name, r"(\p{L})[^\p{L}]*$", 1), F.greatest(draw - 3, F.lit(0))))
    letter = F.regexp_replace(name, r"[^A-Z\u0410-\u042F\u0391-\u03A9.]", "X")
    initials = F.concat(F.repeat(F.lit("X."), F.greatest(draw - 1, F.lit(0))), letter)
    person = F.when(name.rlike(INITIALS), initials).when(swapped, longer).otherwise("")
    octets = [_byte(digest, F.lit(i)).cast("string") for i in range(3)]
    # the leading digit tells the kind of a card, a phone's its country; the last digit of a card is worked out
    kept = F.when(kind.isin("card", "phone"), 1).when(kind == "key", 4).when(kind == "iban", 2).otherwise(0)
    body = (
        F.when(kind == "email", F.regexp_replace(canonical, r"\.[a-z0-9-]+$", ""))
        .when(kind.isin("family", "given"), person)
        .otherwise(F.substring(canonical, kept + 1, F.length(canonical) - kept - (kind == "card").cast("int")))
    )
    hexadecimal = (kind == "secret") & canonical.rlike("^[0-9]*[a-f][0-9a-f]*$") & canonical.rlike("[0-9]")

    def finished(whole: Column) -> Column:
        return (
            F.when(kind == "email", F.concat(whole, F.lit(".example")))
            .when(kind == "ip", F.concat_ws(".", F.lit("10"), *octets))
            .when(kind == "card", F.concat(whole, ((10 - _check_sum(whole, 1) % 10) % 10).cast("string")))
            .when(kind.isin("family", "given") & (whole == ""), listed)
            .otherwise(whole)
        )

    return _bound(finished, whole=F.concat(F.substring(canonical, F.lit(1), kept), _like(body, digest, hexadecimal)))


def _written(kind: Column, value: Column, surrogate: Column) -> Column:
    """The surrogate in the way this mention is written."""
    start = F.struct(F.lit("").alias("s"), F.lit(1).alias("k"))

    def put(a: Column, c: Column) -> Column:
        swap = c.rlike("[A-Z0-9]") & (a["k"] <= F.length(surrogate))
        return F.struct(
            F.concat(a["s"], F.when(swap, F.substring(surrogate, a["k"], F.lit(1))).otherwise(c)).alias("s"),
            (a["k"] + swap.cast("int")).alias("k"),
        )

    filled = F.aggregate(_chars(value), start, put, lambda a: a["s"])
    return F.when(kind.isin("phone", "ssn", "card", "iban"), filled).otherwise(surrogate)


def _entity(match: Column) -> Column:
    """A match with what leads up to it: the title of a name, the word and sign before a secret."""
    lead = F.regexp_extract(match, f"^({TITLE}|{SIGN})", 1)
    value = F.substring(match, F.length(lead) + 1, F.length(match))
    kind = _kind(value, lead)
    return F.struct(lead.alias("lead"), value.alias("value"), kind.alias("kind"), _canonical(kind, value).alias("canonical"))


def _matches(text: Column) -> Column:
    """All entities of a text in order; matches that turn out to be none have no kind."""
    found = F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(ANY), F.lit(0)))
    return F.transform(F.coalesce(found, F.array().cast("array<string>")), _entity)


def draws(entities: DataFrame, key: str) -> DataFrame:
    """Entities (kind, canonical) whose first draw collides: with draw, or null where draws ran out."""
    known = settle(entities.withColumn("draw", F.lit(0)), "entities")
    real = known.filter("kind <> 'given'").select(F.col("kind").alias("real_kind"), F.col("canonical").alias("real"))
    turn = W.partitionBy("kind", "surrogate").orderBy("draw", "canonical")
    for _ in range(DRAWS):
        drawn = known.withColumn("surrogate", _surrogate(F.col("kind"), F.col("canonical"), F.col("draw"), key))
        judged = (
            drawn.withColumn("turn", F.when(F.col("draw").isNotNull(), F.row_number().over(turn)).otherwise(1))
            .join(real, (F.col("kind") == F.col("real_kind")) & (F.col("surrogate") == F.col("real")), "left")
            .withColumn("lost", F.col("draw").isNotNull() & ((F.col("turn") > 1) | F.col("real").isNotNull()))
        )
        judged = settle(judged.select("kind", "canonical", "draw", "lost"), "draws")
        if judged.filter("lost").isEmpty():
            break
        known = judged.select("kind", "canonical", (F.col("draw") + F.col("lost").cast("int")).alias("draw"))
    else:
        known = judged.select("kind", "canonical", F.when(~F.col("lost"), F.col("draw")).alias("draw"))
    return known.filter("draw is null or draw > 0")


def surrogates(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, text with surrogates, n_entities and entities (kind, surrogate)."""
    rows = docs.select(column(id_col).alias("doc_id"), column(text_col).cast("string").alias("text"))
    mentions = settle(
        rows.select("doc_id", F.explode(_matches(F.col("text"))).alias("m"))
        .filter("m.kind is not null")
        .select("doc_id", F.explode(_parts(F.col("m"))).alias("p"))
        .select("doc_id", "p.kind", "p.canonical")
        .distinct(),
        "mentions",
    )
    # a given name under a title without gender is the one under titles of the only gender it has elsewhere
    distinct = settle(mentions.select("kind", "canonical").distinct(), "distinct")
    gender, bare = F.substring("canonical", 1, 1), F.expr("substring(canonical, 3)")
    sexed = distinct.filter("kind = 'given'").filter(gender.isin("m", "f")).groupBy(bare.alias("bare"))
    sexed = sexed.agg(F.min(gender).alias("one"), F.max(gender).alias("other")).filter("one = other")
    sexed = sexed.select(F.lit("given").alias("kind"), F.concat(F.lit("x:"), "bare").alias("canonical"), F.concat("one", F.lit(":"), "bare").alias("same"))
    same = distinct.join(sexed, ["kind", "canonical"], "left").withColumn("same", F.coalesce("same", "canonical"))
    drawn = draws(same.select("kind", F.col("same").alias("canonical")).distinct(), key)
    drawn = drawn.select("kind", F.col("canonical").alias("same"), "draw", F.lit(True).alias("again"))
    redrawn = (
        same.join(drawn, ["kind", "same"], "left")
        .filter("again or same <> canonical")
        .select("kind", "canonical", F.struct("same", F.when(F.col("again"), F.col("draw")).otherwise(0).alias("draw")).alias("draw"))
    )
    by_doc = settle(
        mentions.join(redrawn, ["kind", "canonical"])
        .groupBy("doc_id")
        .agg(F.map_from_entries(F.collect_set(F.struct(F.concat_ws(":", "kind", "canonical"), "draw"))).alias("redrawn"))
        .withColumnRenamed("doc_id", "other"),
        "redrawn",
    )

    def blank(text: Column) -> Column:
        return F.regexp_replace(text, r"[\p{L}\p{N}]", "*")

    def drawn_for(kind: Column, canonical: Column, value: Column) -> Column:
        known = F.concat_ws(":", kind, canonical)
        moved = F.coalesce(F.map_contains_key(F.col("redrawn"), known), F.lit(False))
        draw = F.when(moved, F.element_at("redrawn", known)["draw"]).otherwise(F.lit(0))
        same = F.when(moved, F.element_at("redrawn", known)["same"]).otherwise(canonical)

        def put(kind: Column, value: Column, same: Column, draw: Column) -> Column:
            return F.when(draw.isNull(), blank(value)).otherwise(_written(kind, value, _surrogate(kind, same, draw, key)))

        return _bound(put, kind=kind, value=value, same=same, draw=draw)

    def replaced(m: Column) -> Column:
        kind, canonical, value = m["kind"], m["canonical"], m["value"]
        given = F.transform(_given(m), lambda w: F.when(_is_given(w), drawn_for(F.lit("given"), _given_name(m, w), w)).otherwise(w))
        suffix = F.regexp_extract(value, f"(?<=.)({SUFFIX})$", 1)
        name = F.concat(m["lead"], F.array_join(given, ""), drawn_for(F.lit("family"), canonical, canonical), suffix)
        new = F.when(kind.isNull(), value).when(kind == "name", name).otherwise(drawn_for(kind, canonical, value))
        # a title belongs to the name, the sign before a secret does not
        return F.struct(kind.alias("kind"), new.alias("surrogate"), F.when(kind == "name", "").otherwise(m["lead"]).alias("lead"))

    pieces = F.when(F.size("found") > 0, F.split("text", ANY, -1)).otherwise(F.array("text"))
    put = F.array_append(F.transform("found", lambda m: F.concat(m["lead"], m["surrogate"])), F.lit(""))
    text = F.array_join(F.flatten(F.zip_with(F.col("pieces"), put, lambda p, s: F.array(p, s))), "")
    entities = F.filter("found", lambda m: m["kind"].isNotNull())
    return (
        rows.join(by_doc, F.col("doc_id").eqNullSafe(F.col("other")), "left")
        .select("doc_id", "text", F.transform(_matches(F.col("text")), replaced).alias("found"))
        .withColumn("pieces", pieces)
        .select(
            "doc_id",
            F.when(F.col("text").isNotNull(), text).alias("text"),
            F.size(entities).cast("long").alias("n_entities"),
            F.transform(entities, lambda m: F.struct(m["kind"].alias("kind"), m["surrogate"].alias("surrogate"))).alias("entities"),
        )
    )
