"""URL rules, written with regular expressions.

``parse_url`` rejects blanks, underscores and non-ASCII hosts that real link
columns hold, so only the few parts needed are cut out here.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimloom.functions import as_column
from claimloom.functions.text import WS, strip

# File endings that count as an image.
IMAGE_EXTENSIONS = ("jpg", "jpeg", "png", "gif", "webp", "bmp", "svg")
# Schemes whose last path segment may carry ;parameters.
PARAM_SCHEMES = (
    "ftp", "hdl", "prospero", "http", "https", "shttp", "rtsp", "rtsps", "rtspu",
    "sip", "sips", "mms", "sftp", "tel",
)
# Domains of the fact-checking publishers collected by default.
PUBLISHER_SITES = (
    "politifact.com", "snopes.com", "factcheck.org", "fullfact.org",
    "leadstories.com", "factcheck.afp.com", "reuters.com", "apnews.com",
    "africacheck.org", "boomlive.in", "altnews.in", "correctiv.org",
    "maldita.es", "newtral.es", "rappler.com", "verafiles.org",
)


# Start of a non-empty address without scheme.
_NO_SCHEME = r"\A(?![a-zA-Z][a-zA-Z0-9+.\-]*://)(?=[\s\S])"
# A readable address: something before the first / ? or #, tabs and line breaks
# not counted, and square brackets there only in pairs.
_READABLE = (
    r"(?s)\A([a-zA-Z][a-zA-Z0-9+.\-]*://(?=[\t\r\n]*[^/?#\t\r\n])"
    r"(?:[^/?#\[\]]*|(?=[^/?#]*\[)(?=[^/?#]*\])[^/?#]*)(?:[/?#].*)?)\z"
)


def _with_scheme(c: Column | str) -> Column:
    return F.regexp_replace(strip(c), _NO_SCHEME, "https://")


def prefix_url_scheme(c: Column | str) -> Column:
    """Stripped address with https:// put before one that has no scheme; blank is null."""
    return F.nullif(_with_scheme(c), F.lit(""))


def normalize_url(c: Column | str) -> Column:
    """``prefix_url_scheme``, but null unless a readable authority part follows the scheme."""
    return F.nullif(F.regexp_extract(_with_scheme(c), _READABLE, 1), F.lit(""))


# In schemes with parameters, the first ; of the last path segment ends the path.
_IMAGE = (
    r"(?i)\A(?:(?:{params})://[^/?#]*/(?:[^?#]*/)?[^/?#;]*\.(?:{endings})(?:;[^/?#]*)?"
    r"|(?!(?:{params})://)[a-z][a-z0-9+.\-]*://[^/?#]*/[^?#]*\.(?:{endings}))(?:[?#]|\z)"
).format(params="|".join(PARAM_SCHEMES), endings="|".join(IMAGE_EXTENSIONS))


def is_image_url(normalized: Column | str) -> Column:
    """Whether the path of an already normalised address ends like an image file; null is false."""
    # Parsers skip tabs and line breaks wherever they stand.
    url = F.regexp_replace(as_column(normalized), r"[\t\r\n]", "")
    return F.coalesce(url.rlike(_IMAGE), F.lit(False))


def validate_image_url(c: Column | str) -> Column:
    """``is_image_url`` for a raw address. Offline: nothing is fetched."""
    return is_image_url(normalize_url(c))


def last_url_in_text(c: Column | str) -> Column:
    """The last http(s) link a post mentions, or null."""
    # Java's \S is ASCII; the link ends at any Unicode whitespace.
    not_ws = WS.replace("[", "[^", 1)
    return F.try_element_at(F.regexp_extract_all(as_column(c), F.lit(rf"(https?://{not_ws}+)"), F.lit(1)), F.lit(-1))


def _without_dot_segments(path: Column) -> Column:
    parts = F.split(path, "/")
    kept = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda acc, seg: F.when(seg == ".", acc)
        .when(seg == "..", F.when(F.size(acc) > 1, F.slice(acc, 1, F.size(acc) - 1)).otherwise(acc))
        .otherwise(F.concat(acc, F.array(seg))),
    )
    ends_as_folder = path.rlike(r"/\.\.?$")
    plain = F.array_join(kept, "/")
    cleaned = F.when(ends_as_folder, F.concat(plain, F.lit("/"))).otherwise(plain)
    return F.when(path.rlike(r"(^|/)\.\.?(/|$)"), cleaned).otherwise(path)


def resolve_url(base: Column | str, link: Column | str) -> Column:
    """``link`` as a browser on page ``base`` would follow it."""
    base, link = as_column(base), as_column(link)
    scheme = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.\-]*):", 1)
    root = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*)", 1)
    page = F.regexp_extract(base, r"^[^:]*://[^/?#]*([^?#]*)", 1)
    folder = F.coalesce(F.nullif(F.regexp_extract(page, r"(?s)^(.*/)", 1), F.lit("")), F.lit("/"))
    link_path = F.regexp_extract(link, r"^([^?#]*)", 1)
    link_rest = F.substring(link, F.char_length(link_path) + 1, F.char_length(link))
    absolute = F.when(link.startswith("/"), link_path).otherwise(F.concat(folder, link_path))
    query = F.regexp_extract(base, r"^[^?#]*(\?[^#]*)", 1)
    return (
        F.when(link.rlike(r"^[a-zA-Z][a-zA-Z0-9+.\-]*:"), link)
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("?"), F.concat(root, page, link))
        .when(link.startswith("#"), F.concat(root, page, query, link))
        .otherwise(F.concat(root, _without_dot_segments(absolute), link_rest))
    )


def image_file_name(guid: Column | str, image_url: Column | str) -> Column:
    """File name for a post's image: last part of the post id plus the image's ending (.jpg without one)."""
    name = F.regexp_extract(F.substring_index(as_column(image_url), "?", 1), r"([^/]*)/*\z", 1)
    # A leading dot or a dot at the very end is part of the name, not an ending.
    ending = F.nullif(F.regexp_extract(name, r"(?s).(\.[^.]+)\z", 1), F.lit(""))
    return F.concat(F.substring_index(as_column(guid), "/", -1), F.coalesce(ending, F.lit(".jpg")))
