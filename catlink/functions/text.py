"""Text and key normalisation as native column expressions.

Folding to ASCII is a table generated from Unicode's case folds and compatibility decompositions: one
``translate`` for the folds of one character, and, only in texts that hold such a character, a look-up of
the longer ones (ligatures, circled numbers, unit signs) in one constant map.  Characters without an
ASCII fold are deleted.  Entities are resolved by the HTML 5 table in the same way.  ``*_sql`` functions
give the same chains as DuckDB SQL, for parity checks; they leave out what the test tables don't hold
(long folds beyond Latin letters, entities other than the most usual).
"""

from __future__ import annotations

import html.entities
import re
import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values.
JOINERS = "’'`´"
SMART = {"‘": "'", "’": "'", "“": '"', "”": '"', "–": "-", "—": "-", " ": " "}
LEADING_ARTICLE = r"^(a|an|the)[\s\x1c-\x1f]+"
BLANK_ENDS = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"
LEADING_ARTICLE_MANY = "^(the|a|an|le|la|les|l|los|las|el|un|une|des|il|lo|i) "
DIRECTOR_SEPARATORS = r"(?i)\s*(?:,| and | & | et | y )\s*"


def _ascii(x: str) -> str:
    return x.encode("ascii", "ignore").decode()


#: How a character folds: title keys fold the case first; anchors decompose first; hints only fold the case.
FOLDS = {
    "title": lambda c: _ascii(unicodedata.normalize("NFKD", c.casefold())),
    "anchor": lambda c: _ascii(unicodedata.normalize("NFKD", c)).casefold(),
    "hint": lambda c: c.casefold() if _ascii(c.casefold()) else c.lower(),
}


@cache
def folds(kind: str = "title") -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """(characters, their one-character folds, longer folds), from all code points; a hint's case is folded by ``lower`` elsewhere."""
    one_from, one_to, more = [], [], []
    for n in range(0x110000):
        c = chr(n)
        if 0xD800 <= n < 0xE000 or (kind == "hint" and FOLDS[kind](c) == c.lower()):
            continue
        fold = FOLDS[kind](c)
        if len(fold) == 1 and fold != c:
            one_from.append(c)
            one_to.append(fold)
        elif len(fold) > 1:
            more.append((c, fold))
    return "".join(one_from), "".join(one_to), tuple(more)


def _class(characters: list[str]) -> str:
    """A regular expression's class of characters, as ranges."""
    out, first, last = [], None, None
    for n in [*sorted(map(ord, characters)), None]:
        if first is not None and n != last + 1:
            out.append(f"\\x{{{first:x}}}-\\x{{{last:x}}}" if last > first else f"\\x{{{first:x}}}")
            first = n
        first, last = n if first is None else first, n
    return "[" + "".join(out) + "]"


#: Separate the keys and values of a constant table.
KEY, VALUE = "\x1e", "\x1f"


def _table(entries: dict[str, str]) -> str:
    """A constant table as one string: cheap in a plan, searched only for the rare texts that need it."""
    return "".join(f"{KEY}{k}{VALUE}{v}" for k, v in entries.items()) + KEY


def _find(table: str, key: Column) -> Column:
    """The value (of 24 characters at most) of a key without control characters, or null."""
    mark = F.concat(F.lit(KEY), key, F.lit(VALUE))
    place = F.instr(F.lit(table), mark)
    return F.when(place > 0, F.split_part(F.substr(F.lit(table), place + F.length(mark), F.lit(24)), F.lit(KEY), F.lit(1)))


def _only(table: str | Column, key: Column) -> Column:
    """As ``_find`` for values that are never empty: the empty string where there is none, and one use of the table."""
    rest = F.split_part(F.lit(table), F.concat(F.lit(KEY), key, F.lit(VALUE)), F.lit(2))
    return F.split_part(F.substr(rest, F.lit(1), F.lit(24)), F.lit(KEY), F.lit(1))


@cache
def _longer(kind: str) -> tuple[str, str]:
    more = folds(kind)[2]
    return _class([c for c, _ in more]), _table(dict(more))


def _squeeze(x: Column) -> Column:
    return F.trim(F.regexp_replace(x, r"\s+", " "))


def _fold(x: Column, kind: str) -> Column:
    source, target, more = folds(kind)
    held, table = _longer(kind)
    x = F.translate(x, source, target)  # first: what the longer folds leave in upper case stays so
    each = F.transform(F.regexp_extract_all(x, F.lit("(?s)."), F.lit(0)), lambda c: F.coalesce(F.nullif(_only(table, c), F.lit("")), c))
    return F.when(x.rlike(held), F.array_join(each, "")).otherwise(x)


def fold_ascii(x: Column, kind: str = "title") -> Column:
    """Folded to lower-case ASCII; what has no fold is deleted."""
    return F.regexp_replace(_fold(x, kind), r"[^\x00-\x7f]", "")


def normalize_title(x: Column) -> Column:
    """Key of a title: folded, joiners deleted, ampersands spelled, one leading English article dropped, words only."""
    x = F.regexp_replace(fold_ascii(F.regexp_replace(F.coalesce(x, F.lit("")), BLANK_ENDS, "")), f"[{JOINERS}]", "")
    x = F.regexp_replace(F.replace(x, F.lit("&"), F.lit(" and ")), LEADING_ARTICLE, "")
    return F.trim(F.regexp_replace(x, "[^a-z0-9]+", " "))


def drop_initials(x: Column) -> Column:
    """Words of more than one character."""
    return F.array_join(F.filter(F.split(x, " "), lambda w: F.length(w) > 1), " ")


def normalize_person(x: Column) -> Column:
    return drop_initials(normalize_title(x))


def exact_key(x: Column) -> Column:
    return F.replace(F.lower(F.trim(x)), F.lit("ß"), F.lit("ss"))


def reanchor_key(x: Column) -> Column:
    """Folded words; every sign becomes a space."""
    return _squeeze(F.regexp_replace(fold_ascii(F.coalesce(x, F.lit("")), "anchor"), r"[^a-z0-9_\s]", " "))


def reanchor_title(x: Column) -> Column:
    """Folded words without one leading article of several languages."""
    return F.trim(F.regexp_replace(reanchor_key(x), LEADING_ARTICLE_MANY, ""))


def reanchor_person(x: Column) -> Column:
    return drop_initials(reanchor_key(x))


#: The most usual entities, which the SQL forms know.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"))
REFERENCE = r"&(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
#: References that are resolved without a search; the ampersand comes last, so that none is resolved twice.
USUAL = {**{f"{k};": html.entities.html5[f"{k};"] for k in ("lt", "gt", "quot", "apos", "nbsp", "copy", "middot")}, "#39;": "'", "amp;": "&"}
UNUSUAL = rf"&(?!{'|'.join(USUAL)})(?:#[0-9]|#[xX][0-9a-fA-F]|[^\t\n\f <&#;])"
#: Numbers of printable ASCII characters.
PLAIN_NUMBER = "^#(?:3[2-9]|[4-9][0-9]|1[01][0-9]|12[0-6]);?$"


@cache
def _entities() -> tuple[dict[str, str], str, str]:
    """(named entities by first letter, those that stand without a semicolon as an alternation, numbers with a meaning of their own), from the HTML 5 table."""
    table = html.entities.html5
    named = {c: _table({k: v for k, v in table.items() if k[0] == c}) for c in sorted({k[0] for k in table})}
    bare = sorted((k for k in table if not k.endswith(";")), key=len, reverse=True)
    # numbers of the C1 range stand for the characters of code page 1252
    low = {n: bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(0x80, 0xA0)}
    controls = [n for n in (*range(1, 9), 0xB, *range(0xE, 0x20), 0x7F)]
    codes = {**{str(n): c for n, c in low.items()}, **{str(n): "" for n in controls}, "0": "\ufffd", "13": "\r"}
    return named, "|".join(bare), _table(codes)


def _reference(ref: Column) -> Column:
    """The text of one character reference, given without its ampersand."""
    named, bare, codes = _entities()
    digits = F.regexp_extract(ref, r"^#0*([0-9]*)", 1)
    # numbers of more digits than any code point has are read as one beyond them
    decimal = F.when(F.length(digits) > 9, 0x110000).otherwise(F.coalesce(digits.try_cast("long"), F.lit(0)))
    digits16 = F.regexp_extract(ref, r"^#[xX]0*([0-9a-fA-F]*)", 1)
    hexadecimal = F.when(F.length(digits16) > 7, 0x110000).otherwise(F.coalesce(F.conv(digits16, 16, 10).try_cast("long"), F.lit(0)))
    number = F.when(ref.rlike("^#[xX]"), hexadecimal).otherwise(decimal)
    plane = number.bitwiseAND(F.lit(0xFFFF)) >= 0xFFFE  # not characters, like FDD0-FDEF
    one = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    of_number = F.coalesce(
        _find(codes, number.cast("string")),
        F.when((number > 0x10FFFF) | number.between(0xD800, 0xDFFF), "\ufffd").when(plane | number.between(0xFDD0, 0xFDEF), "").otherwise(one),
    )
    # the whole reference, else the longest name that may stand without a semicolon; one search in the table for both
    head = F.regexp_extract(ref, f"^({bare})", 1)
    initial = F.create_map(*[F.lit(v) for pair in named.items() for v in pair])
    of_initial = F.coalesce(F.try_element_at(initial, F.substr(ref, F.lit(1), F.lit(1))), F.lit(KEY))
    told = F.transform(F.filter(F.array(F.when(ref.rlike("^[A-Za-z0-9]+;?$"), ref).otherwise(""), head), lambda k: k != ""), lambda k: F.struct(k.alias("k"), _only(of_initial, k).alias("v")))
    hit = F.get(F.filter(told, lambda t: t["v"] != ""), F.lit(0))
    of_name = F.coalesce(F.concat(hit["v"], F.substr(ref, F.length(hit["k"]) + 1)), F.concat(F.lit("&"), ref))
    usual = F.when(ref == "amp;", "&")
    for k, v in USUAL.items():
        usual = usual.when(ref == k, v) if k != "amp;" else usual
    plain = F.char(F.regexp_extract(ref, "^#([0-9]+)", 1).cast("int"))
    return usual.when(ref.rlike(PLAIN_NUMBER), plain).when(F.startswith(ref, F.lit("#")), of_number).otherwise(of_name)


def unescape_entities(x: Column) -> Column:
    """Character references resolved once, by name (with or without a semicolon, as HTML 5 has them) and by number."""

    def resolve(text: Column) -> Column:
        refs = F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(1))
        return F.array_join(F.zip_with(F.split(text, REFERENCE, -1), F.transform(refs, _reference), lambda p, r: F.concat(p, F.coalesce(r, F.lit("")))), "")

    def usual(text: Column) -> Column:
        for k, v in USUAL.items():
            text = F.replace(text, F.lit(f"&{k}"), F.lit(v))
        return text

    # the text is bound to a name, so it is neither computed nor written into the plan again for each use
    told = lambda t: F.when(~F.coalesce(F.contains(t, F.lit("&")), F.lit(False)), t).when(~t.rlike(UNUSUAL), usual(t)).otherwise(resolve(t))
    return F.get(F.transform(F.array(x), told), F.lit(0))


def hint_key(x: Column) -> Column:
    """Key of web titles: case folded, entities resolved, dashes unified, article dropped before ampersands; other letters deleted."""
    x = unescape_entities(F.lower(_fold(F.regexp_replace(F.coalesce(x, F.lit("")), BLANK_ENDS, ""), "hint")))
    x = F.regexp_replace(F.regexp_replace(x, "[–—]", "-"), f"[{JOINERS}]", "")
    x = F.replace(F.regexp_replace(x, r"(?U)" + LEADING_ARTICLE, ""), F.lit("&"), F.lit(" and "))
    return F.trim(F.regexp_replace(F.regexp_replace(x, r"[^\x00-\x7f]", ""), "[^a-z0-9]+", " "))


def hint_person(x: Column) -> Column:
    return drop_initials(hint_key(x))


def page_key(x: Column) -> Column:
    """Key of page titles: smart signs to ASCII, lower case, single spaces, no trailing signs."""
    x = F.translate(F.coalesce(x, F.lit("")), "".join(SMART), "".join(SMART.values()))
    return F.regexp_replace(_squeeze(F.lower(x)), r"[\s.,;:!?\-]+$", "")


def split_names(x: Column) -> Column:
    """Names of a credit field; a field of separators only is one name."""
    parts = F.filter(F.transform(F.split(F.trim(x), DIRECTOR_SEPARATORS), lambda p: F.trim(p)), lambda p: p != "")
    return F.when(F.trim(F.coalesce(x, F.lit(""))) == "", F.array().cast("array<string>")).when(F.size(parts) > 0, parts).otherwise(F.array(F.trim(x)))


def name_sets_match(a: Column, b: Column) -> Column:
    """Do two arrays of normalised names share a name, or one name's words lie within another's?"""
    words = lambda x: F.transform(F.filter(x, lambda n: n != ""), lambda n: F.array_sort(F.array_distinct(F.split(n, " "))))
    # names of equally many words match only as equal sets, which the overlap finds first
    inside = lambda s, t: (F.size(s) < F.size(t)) & (F.size(F.array_except(s, t)) == 0)
    nested = F.exists(words(a), lambda m: F.exists(words(b), lambda n: inside(m, n) | inside(n, m)))
    return F.coalesce(F.when(F.arrays_overlap(words(a), words(b)), True).otherwise(nested), F.lit(False))


def strip_tags(x: Column) -> Column:
    """Text of HTML: entities resolved, tags to spaces, white space squeezed."""
    return _squeeze(F.translate(F.regexp_replace(unescape_entities(F.coalesce(x, F.lit(""))), "<[^>]+>", " "), " ", " "))


def token_jaccard(a: Column, b: Column) -> Column:
    """Jaccard similarity of the words of two page titles; 0 if either has none."""
    words = lambda x: F.filter(F.array_distinct(F.split(page_key(x), " ")), lambda w: w != "")
    one, two = words(a), words(b)
    both = F.size(F.array_union(one, two))
    return F.when((F.size(one) == 0) | (F.size(two) == 0), F.lit(0.0)).otherwise(F.size(F.array_intersect(one, two)) / both)


def set_jaccard(a: Column, b: Column) -> Column:
    """Jaccard similarity of two sets; two empty sets are equal."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def contains_either_way(a: Column, b: Column) -> Column:
    return (a == b) | F.contains(a, b) | F.contains(b, a)


def decode_json_text(x: Column) -> Column:
    """A JSON string's content; what is no JSON string has its entities and escaped slashes resolved."""
    return F.coalesce(F.from_json(F.concat(F.lit('{"x":"'), x, F.lit('"}')), "x string")["x"], F.replace(unescape_entities(x), F.lit("\\/"), F.lit("/")))


def file_stem(x: Column) -> Column:
    return F.coalesce(F.nullif(F.replace(normalize_title(x), F.lit(" "), F.lit("_")), F.lit("")), F.lit("collection_lookup"))


def series_number(x: Column, pattern: str) -> Column:
    """The number that a pattern's first group finds, or null."""
    return F.expr("null").cast("int") if not pattern else F.regexp_extract(x, pattern, 1).try_cast("int")


def title_and_year(x: Column) -> Column:
    """struct(title, year): the first year of 18xx-20xx as a word, and what stands before it; null without either."""
    compact = _squeeze(F.translate(F.coalesce(x, F.lit("")), "".join(SMART), "".join(SMART.values())))
    year = F.regexp_extract(compact, r"\b((?:18|19|20)[0-9]{2})\b", 1)
    title = F.regexp_replace(F.regexp_extract(compact, r"^(.*?)\b(?:18|19|20)[0-9]{2}\b", 1), r"^[ :\-]+|[ :\-]+$", "")
    return F.when((year != "") & (title != ""), F.struct(title.alias("title"), year.cast("int").alias("year")))


# --- typed values of text ---------------------------------------------------------------------


def strict_int(x: Column) -> Column:
    """A year or minutes: blank, \\N and anything but a whole number is null."""
    return F.when(F.trim(x).rlike("^[+-]?[0-9]{1,9}$"), F.trim(x).try_cast("int"))


def lenient_int(x: Column) -> Column:
    """A number's whole part; null for what is no number."""
    return F.when(F.trim(x).rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), F.trim(x).try_cast("double").try_cast("int"))


def tri_bool(x: Column) -> Column:
    y = F.lower(F.trim(x))
    return F.when(y == "true", True).when(y == "false", False)


def yes_no(x: Column) -> Column:
    """Override flags: true/1/yes, false/0/no, else null."""
    y = F.lower(F.trim(x))
    return F.when(y.isin("true", "1", "yes"), True).when(y.isin("false", "0", "no"), False)


# --- the same chains as SQL -------------------------------------------------------------------


def quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def fold_sql(x: str, kind: str = "title") -> str:
    source, target, more = folds(kind)
    for a, b in more:
        if ord(a) < 0x250 or 0x2010 <= ord(a) < 0x2040 or 0xFB00 <= ord(a) < 0xFB07:
            x = f"replace({x}, {quoted(a)}, {quoted(b)})"
    some = [i for i, c in enumerate(source) if ord(c) < 0x10000]
    source, target = "".join(source[i] for i in some), "".join(target[i] for i in some)
    return f"regexp_replace(translate({x}, {quoted(source)}, {quoted(target)}), '[^\\x00-\\x7f]', '', 'g')"


def title_sql(x: str) -> str:
    y = f"regexp_replace({fold_sql(f'coalesce(trim({x}), {quoted("")})')}, {quoted(f'[{JOINERS}]')}, '', 'g')"
    y = f"regexp_replace(replace({y}, '&', ' and '), {quoted(LEADING_ARTICLE)}, '')"
    return f"trim(regexp_replace({y}, '[^a-z0-9]+', ' ', 'g'))"


def initials_sql(x: str) -> str:
    return f"array_to_string(list_filter(string_split({x}, ' '), lambda w: length(w) > 1), ' ')"


def person_sql(x: str) -> str:
    return initials_sql(title_sql(x))


def exact_sql(x: str) -> str:
    return f"replace(lower(trim({x})), 'ß', 'ss')"


def reanchor_sql(x: str) -> str:
    y = f"regexp_replace({fold_sql(f'coalesce({x}, {quoted("")})', 'anchor')}, '[^a-z0-9_\\s]', ' ', 'g')"
    return f"trim(regexp_replace({y}, '\\s+', ' ', 'g'))"


def reanchor_title_sql(x: str) -> str:
    return f"trim(regexp_replace({reanchor_sql(x)}, {quoted(LEADING_ARTICLE_MANY)}, ''))"


def entities_sql(x: str) -> str:
    for a, b in ENTITIES:
        x = f"replace({x}, {quoted(a)}, {quoted(b)})"
    return x


def hint_sql(x: str) -> str:
    y = entities_sql(f"lower(replace(trim(coalesce({x}, '')), 'ß', 'ss'))")
    y = f"regexp_replace(regexp_replace({y}, '[–—]', '-', 'g'), {quoted(f'[{JOINERS}]')}, '', 'g')"
    y = f"replace(regexp_replace({y}, {quoted(LEADING_ARTICLE)}, ''), '&', ' and ')"
    y = f"regexp_replace({y}, '[^\\x00-\\x7f]', '', 'g')"
    return f"trim(regexp_replace({y}, '[^a-z0-9]+', ' ', 'g'))"


def page_sql(x: str) -> str:
    y = f"translate(coalesce({x}, ''), {quoted(''.join(SMART))}, {quoted(''.join(SMART.values()))})"
    return f"regexp_replace(trim(regexp_replace(lower({y}), '\\s+', ' ', 'g')), '[\\s.,;:!?\\-]+$', '')"


def names_sql(x: str) -> str:
    parts = f"list_filter(list_transform(regexp_split_to_array(trim({x}), '(?i)\\s*(?:,| and | & | et | y )\\s*'), lambda p: trim(p)), lambda p: p <> '')"
    return f"CASE WHEN trim(coalesce({x}, '')) = '' THEN []::VARCHAR[] WHEN len({parts}) > 0 THEN {parts} ELSE [trim({x})] END"


def strip_tags_sql(x: str) -> str:
    y = f"regexp_replace({entities_sql(f'coalesce({x}, {quoted("")})')}, '<[^>]+>', ' ', 'g')"
    return f"trim(regexp_replace(translate({y}, ' ', ' '), '\\s+', ' ', 'g'))"


def python_title(text: str) -> str:
    """Reference implementation of ``normalize_title`` for tests and small constant tables."""
    x = unicodedata.normalize("NFKD", (text or "").strip().casefold()).encode("ascii", "ignore").decode()
    x = re.sub(f"[{JOINERS}]", "", x).replace("&", " and ")
    return " ".join(re.sub("[^a-z0-9]+", " ", re.sub(LEADING_ARTICLE, "", x)).split())
