"""Column functions: text normalisation, attribute extraction, keys and similarities, all within the JVM.

Defined results.  Null texts count as empty.  Texts of any length are taken
whole.  Similarities of two empty sets are null where no default is given.
"""

import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# The vocabularies and patterns that results depend on.
STOPWORDS = ("a", "as", "com", "da", "das", "de", "do", "dos", "e", "em", "for", "of", "o", "os", "para", "the", "with")
GENERIC_BRANDS = ("", "generic", "generico", "genérico")
SPEC_KEYS = {"asin": ("asin",), "ean": ("ean", "codigo ean"), "gtin": ("gtin",), "upc": ("upc",)}
ID_PATTERNS = {"asin": r"(?i)\bB0[A-Z0-9]{8}\b", "ean": r"\b\d{13}\b", "upc": r"\b\d{12}\b"}
SIZE = r"(?i)(?<![a-z0-9])(\d+(?:[,.]\d+)?)\s*(fl\s*oz|floz|ml|l|g|kg|oz)(?![a-z])"
PACK = r"\b(?:pack\s*(?:of)?|kit|combo|dupla|trio|com|contem)?\s*(\d{1,3})\s*(?:produtos|produto|unidades|unidade|pcs|pecas|itens|items|un|x)\b"
MODEL = r"\b(?=[a-z0-9]*\d)(?:[a-z]{1,5}\d[a-z0-9]{2,}|\d+[a-z]{1,4}\d*)\b"
SIZE_ONLY = r"^\d+(?:ml|g|kg|oz|l|h)?$"
NO_MARK = "abcdefghijklmnopqrstuvwxyz0123456789%"  # one by one: the JVM looks these up in a table, but tries ranges in turn
REDIRECTS = ("click", "count", "redirect", "redir", "goto", "tracking", "track", "affiliate", "afiliado", "adservice", "ads")


@cache
def _decomposed() -> tuple[str, str, dict[str, str]]:
    """What compatibility decomposition without combining marks does to characters, as far as it leaves any of a-z 0-9 % & ' ` or nothing.

    (matching, replacement) for translate, which drops the last ones of matching; and the characters that become several.
    All others end as separators, decomposed or not.
    """
    one, gone, several = {}, [], {}
    for code in range(128, 0x20000):
        c = chr(code)
        base = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x)) if not 0xD800 <= code < 0xE000 else c
        if base == "":
            gone.append(c)
        elif base != c and any(x in "abcdefghijklmnopqrstuvwxyz0123456789%&'`" for x in base):
            (one if len(base) == 1 else several)[c] = base
    return "".join(one) + "".join(gone), "".join(one.values()), several


def strip_accents(c: Column) -> Column:
    """The text decomposed, without combining marks; ASCII texts pass as they are.

    Three literals hold the tables, so that the expression stays small: those of
    the characters that become several are cut from one text by their place in another.
    """
    matching, replacement, several = _decomposed()
    keys, width = "".join(several), max(map(len, several.values()))
    values = "".join(v.ljust(width) for v in several.values())
    place = lambda x: F.instr(F.lit(keys), x)
    apart = F.array_join(F.transform(F.split(c, ""), lambda x: F.when(place(x) > 0, F.rtrim(F.substr(F.lit(values), (place(x) - 1) * width + 1, F.lit(width)))).otherwise(x)), "")
    plain = F.when(c.rlike(f"[{keys}]"), apart).otherwise(c)
    return F.when(c.rlike(r"[^\x00-\x7F]"), F.translate(plain, matching, replacement)).otherwise(c)


def folded(c: Column) -> Column:
    """The text in lower case without accents.  It takes a text apart several times over: project it before it is used on."""
    return strip_accents(F.lower(F.coalesce(c, F.lit(""))))


def squeezed(c: Column) -> Column:
    """Of a folded text: & as a word, apostrophes gone, other marks as single blanks."""
    t = F.regexp_replace(F.replace(c, F.lit("&"), F.lit(" e ")), "['`]", "")
    return F.trim(F.regexp_replace(t, f"[^{NO_MARK}]+", " "))


def normalize_text(c: Column) -> Column:
    """Lower case, accents off, & as a word, apostrophes gone, other marks as single blanks."""
    return squeezed(folded(c))


def informative_tokens(norm: Column, limit: int = 5) -> Column:
    """Of a normalised text: the first tokens of over two characters that are no stop words."""
    return F.slice(F.filter(F.split(norm, " "), lambda t: (F.length(t) > 2) & ~t.isin(*STOPWORDS)), 1, limit)


def compact(norm: Column) -> Column:
    """A normalised text as one token."""
    return F.regexp_replace(norm, "[^a-z0-9]", "")


def normalize_brand(c: Column) -> Column:
    return compact(normalize_text(c))


def category_path(low: Column) -> Column:
    """The normalised parts of a folded category."""
    return F.filter(F.transform(F.split(low, "[>›/|]+"), squeezed), lambda x: x != "")


def price_cents(c: Column) -> Column:
    """Whole cents, towards zero; null where the text is no number or too large."""
    v = F.trim(c).try_cast("double")
    return F.when(F.isnan(v) | (F.abs(v) > 2**31 - 1), None).otherwise(v.cast("int"))


def size_hits(text: Column) -> Column:
    """All sizes in a text as (value, unit), in base units ml and g."""
    def base(hit: Column) -> Column:
        v = F.replace(F.regexp_extract(hit, r"^\d+(?:[,.]\d+)?", 0), F.lit(","), F.lit(".")).cast("double")
        u = F.lower(F.regexp_replace(hit, r"^\d+(?:[,.]\d+)?|\s+", ""))
        factor = F.when(u.isin("l", "kg"), 1000.0).when(u == "floz", 29.5735).when(u == "oz", 28.3495).otherwise(1.0)
        return F.struct((v * factor).alias("value"), F.when(u.isin("l", "ml", "floz"), "ml").otherwise("g").alias("unit"))

    return F.transform(F.regexp_extract_all(text, F.lit(SIZE), F.lit(0)), base)


def pack_count(norm: Column) -> Column:
    """The first number of pieces that a normalised text names, where it is over 1."""
    n = F.when(norm.rlike("[0-9] *[puix]"), F.regexp_extract(norm, PACK, 1).try_cast("int"))  # the first letters of PACK's words: most texts are told by this short pattern
    return F.when(n > 1, n)


def identifier(name: str, entries: Column, haystack: Column) -> Column:
    """An id of SPEC_KEYS: the last value among the specs' normalised entries (k, v), else the first hit of its pattern, else empty."""
    value = F.try_element_at(F.filter(entries, lambda e: e["k"].isin(*SPEC_KEYS[name])), F.lit(-1))["v"]
    found = F.lower(F.regexp_extract(haystack, ID_PATTERNS[name], 0)) if name in ID_PATTERNS else F.lit("")
    if name == "asin":  # a plain search for its head is cheaper than the pattern
        found = F.when(F.contains(haystack, F.lit("B0")) | F.contains(haystack, F.lit("b0")), found).otherwise("")
    return F.coalesce(value, found)


def model_tokens(norm: Column) -> Column:
    """Sorted distinct tokens of a normalised text that hold letters and digits and are not sizes."""
    return F.array_sort(F.array_distinct(F.filter(F.regexp_extract_all(norm, F.lit(MODEL), F.lit(0)), lambda t: ~t.rlike(SIZE_ONLY))))


def trusted_url(host: Column, path: Column) -> Column:
    """Whether a folded host and path lead to a product page: no redirect or tracking word, and a token with a digit or two telling ones in the path."""
    words = squeezed(path)
    tokens = F.filter(F.split(words, " "), lambda t: F.length(t) >= 3)
    length = F.aggregate(tokens, F.lit(0), lambda n, t: n + F.length(t))
    telling = F.when(words.rlike("(?:^| )(?=[^ ]*[0-9])[^ ]{3}"), True).otherwise((F.size(tokens) >= 2) & (length >= 12))
    return ~F.concat(host, F.lit("/"), path).rlike("|".join(REDIRECTS)) & telling


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url, without a leading www., the last segment's parameters and slashes at the end."""
    clean = F.regexp_replace(F.regexp_replace(F.coalesce(url, F.lit("")), "[\t\r\n]", ""), r"^[\x00-\x20]+", "")
    pattern = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)([^?#]*)"
    host = F.regexp_replace(F.regexp_extract(clean, pattern, 1), r"(?i)^www\.", "")
    return host, F.regexp_replace(F.regexp_replace(F.regexp_extract(clean, pattern, 2), ";[^/]*$", ""), "/+$", "")


def canonical_url(host: Column, path: Column) -> Column:
    """A trusted url's folded host and path as one key, else empty."""
    key = F.substring(F.replace(squeezed(F.concat_ws(" ", host, path)), F.lit(" "), F.lit("/")), 1, 240)
    return F.when((host != "") & (path != "") & trusted_url(host, path), key).otherwise("")


def embedding_text(**parts: Column) -> Column:
    """Lines `key: value` of the parts that are not empty."""
    return F.concat_ws("\n", *[F.when(F.coalesce(v, F.lit("")) != "", F.concat(F.lit(f"{k}: "), v)) for k, v in parts.items()])


def trigrams(c: Column) -> Column:
    """The distinct trigrams of a text's words, each padded by two blanks before and one behind."""
    words = F.filter(F.split(c, "[^a-z0-9]+"), lambda w: w != "")
    grams = F.transform(words, lambda w: F.transform(F.sequence(F.lit(1), F.length(w) + 1), lambda i: F.substr(F.concat(F.lit("  "), w, F.lit(" ")), i, F.lit(3))))
    return F.array_distinct(F.flatten(grams))


def jaccard(a: Column, b: Column) -> Column:
    """Shared elements by all elements; null where both are empty."""
    n = F.size(F.array_intersect(a, b))
    return F.try_divide(n, F.size(a) + F.size(b) - n)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
