"""Text expressions: clean-up, names, sentences, evidence quotes, addresses, digests."""

import html
import html.entities
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Place kinds and the words that name them; only the shop words are case-sensitive.
PLACE_WORDS = {
    "bar": r"\b(?:Bar|Bars|Kneipe|Kneipen|Gaststätte|Gaststätten)\b",
    "nightclub": r"\b(?:Diskothek|Diskotheken|Nachtclub|Nachtclubs|Tanzlokal)\b",
    "station": r"\b(?:(?:U|S|U- und S)-)?Bahnhof\b|\b(?:Bahnhöfe|Bahnsteig|Bahnsteigen)\b",
    "restaurant": r"\b(?:Restaurant|Restaurants)\b",
    "cafe": r"\b(?:Café|Cafés|Cafe|Cafes)\b",
    "fast_food": r"\b(?:Imbiss|Schnellrestaurant|Fastfoodrestaurant)\b",
    "shop": r"\b(?:Supermarkt|Supermärkte|Geschäft|Geschäfte|Einkaufszentrum|Kaufhaus|Spätkauf|Laden)\b",
    "park": r"\b(?:Park|Parkanlage|Parkanlagen)\b",
    "parking": r"\b(?:Parkplatz|Parkhaus|Tiefgarage)\b",
    "hotel": r"\b(?:Hotel|Hotels|Hotellobby)\b",
    "airport": r"\b(?:Flughafen|Flughäfen|Flughafenterminal)\b",
    "marketplace": r"\b(?:Wochenmarkt|Weihnachtsmarkt|Marktplatz)\b",
    "attraction": r"\b(?:Sehenswürdigkeit|Museum|Museen)\b",
}


def collapsed(text: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def mentions(text: Column) -> Column:
    """Kinds of places that a text names, sorted."""
    return F.array_sort(F.array_compact(F.array(*(F.when(text.rlike(("(?U)" if kind == "shop" else "(?iuU)") + words), kind) for kind, words in PLACE_WORDS.items()))))


@F.pandas_udf(StringType())
def nfkc(texts: pd.Series) -> pd.Series:
    """Unicode NFKC and case folding, for which Spark has no function."""
    return texts.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x).casefold())


@F.pandas_udf(StringType())
def nfkc_only(texts: pd.Series) -> pd.Series:
    return texts.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))


def unusual(text: Column) -> Column:
    """Whether a text has letters outside ASCII and the German alphabet; only such texts need Python."""
    return text.rlike("[^\\x00-\\x7FäöüÄÖÜß‐‑‒–—−]")


def compatible(text: Column) -> Column:
    """A text with compatibility forms (ligatures, wide letters) as plain ones."""
    return F.when(unusual(text), nfkc_only(text)).otherwise(text)


def lowered(text: Column) -> Column:
    return F.replace(F.lower(text), F.lit("ß"), F.lit("ss"))


# What a name's spellings become, in this order.
SPELLINGS = (
    (r"\bs-\s*(?:und\s+|/\s*)u-bahnhof(?:s)?\b", "s+u-bahnhof"),
    (r"\b([us](?:\+u)?-bahnhof|bahnhof)s\b", "$1"),
    (r"\s*-\s*", "-"),
    (r"(?U)(?<=\w)str\.(?=\s|$|[,;/])", "strasse"),
    (r"\bstr\.(?=\s|$|[,;/])", "strasse"),
)


def spelled(folded: Column) -> Column:
    """One kind of dash, no space around it, strasse for str., no genitive s at Bahnhof."""
    x = F.translate(folded, "‐‑‒–—−", "------")
    for pattern, to in SPELLINGS:
        x = F.regexp_replace(x, pattern, to)
    return collapsed(x)


def street_name(text: Column) -> Column:
    """A German name for comparison: compatibility forms and case folded (ß is ss), spelled() in one way."""
    return spelled(F.when(unusual(text), nfkc(text)).otherwise(lowered(text)))


def sentences(text: Column) -> Column:
    """Sentences of a text; full stops in dates and after a few short forms end none."""
    guarded = F.regexp_replace(text, r"(\b(?:St|Dr|Nr|bzw|ca|Str)|\d)\.(?=\s)", "$1\u0001")
    return F.transform(F.filter(F.split(guarded, r"(?<=[.!?])\s+"), lambda s: F.trim(s) != ""), lambda s: F.translate(F.trim(s), "\u0001", "."))


def quotes_hold(quotes: Column, body: Column, least: int = 15, most: int = 240) -> Column:
    """Whether all quotes are literal parts of a body, of a fair length, and none repeats."""
    fine = F.forall(quotes, lambda q: F.length(q).between(least, most) & body.contains(q))
    return (F.size(quotes) > 0) & fine & (F.size(F.array_distinct(quotes)) == F.size(quotes))


def content_hash(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def canonical_url(url: Column) -> Column:
    """https, lower-case host, no query or fragment, no slash at the end."""
    host = F.lower(F.regexp_extract(url, r"^[a-zA-Z]+://([^/?#]+)", 1))
    path = F.regexp_replace(F.regexp_extract(url, r"^[a-zA-Z]+://[^/?#]+([^?#]*)", 1), "/+$", "")
    return F.when(host != "", F.concat(F.lit("https://"), host, path))


@F.pandas_udf(StringType())
def html_unescape(texts: pd.Series) -> pd.Series:
    """References by name and number as characters, by the rules of HTML."""
    return texts.map(lambda x: None if x is None else html.unescape(x))


@F.pandas_udf(StringType())
def html_unescape_ended(texts: pd.Series) -> pd.Series:
    """References that end with a semicolon, the unknown ones as they are."""
    known = lambda m: html.unescape(m[0]) if m[0][1] == "#" or m[0][1:] in html.entities.html5 else m[0]
    return texts.map(lambda x: None if x is None else re.sub(r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);", known, x))


def unescaped(text: Column, ended: bool = False) -> Column:
    """All character references of HTML as characters; `ended`: only those that end with a semicolon, as a cut text's last one does not."""
    return F.when(text.contains("&"), (html_unescape_ended if ended else html_unescape)(text)).otherwise(text)


def filled(template: Column, values: Column) -> Column:
    """A template with each {name} replaced by the map's value of that name."""
    return F.aggregate(F.map_entries(values), template, lambda t, e: F.replace(t, F.concat(F.lit("{"), e["key"], F.lit("}")), e["value"]))
