"""Names, labels, paths and addresses as column expressions.

An empty string counts as missing wherever a field falls back to another.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Addresses, pages and labels of the collection's layout.
PDF_BASE = "/pdfs/attachment/"
SOURCE_BASE = "/api/attachment/view-pdf/"
MOVED_PREFIXES = ("/api/attachment/view-pdf/", "/api/attachment/block-image/")
PAGES = ("home", "view", "summary", "notice", "gallery")
TITLE_PREFIX_EN, TITLE_SUFFIX_BN = "Report of the ", "  এর প্রতিবেদন "
CHAPTER_LABEL = " অধ্যায়-"
LANGUAGES = {
    "bn": "Bangla", "ca": "Català", "da": "Dansk", "de": "Deutsch", "en": "English", "es": "Español", "fr": "Français", "gl": "Galego", "hu": "Magyar",
    "it": "Italiano", "ja": "日本語", "ko": "한국어", "nl": "Nederlands", "pl": "Polski", "pt-br": "Português (Brasil)", "pt-pt": "Português", "ro": "Română",
    "ru": "Русский", "sv": "Svenska", "tr": "Türkçe", "zh-cn": "中文（简体）", "zh-tw": "繁體中文",
}


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nz(c: Column | str) -> Column:
    """The value, or null for an empty string."""
    return F.nullif(col(c), F.lit(""))


def truthy(c: Column | str) -> Column:
    """A boolean whose null is false."""
    return F.coalesce(col(c), F.lit(False))


def first_of(*cs: Column | str, default: str | None = None) -> Column:
    """The first that is neither null nor empty."""
    rest = [] if default is None else [F.lit(default)]
    return F.coalesce(*[nz(c) for c in cs], *rest)


def localized(lang: Column | str, bangla: Column | str, english: Column | str) -> Column:
    """The field of the language, else that of the other one. ``lang`` is a code or a column of codes."""
    bn, en = first_of(bangla, english), first_of(english, bangla)
    if isinstance(lang, str):
        return bn if lang == "bn" else en
    return F.when(lang == "bn", bn).otherwise(en)


def localized_strict(lang: Column | str, bangla: Column | str, english: Column | str) -> Column:
    """The field of the language as it is, without a fallback."""
    if isinstance(lang, str):
        return col(bangla) if lang == "bn" else col(english)
    return F.when(lang == "bn", col(bangla)).otherwise(col(english))


def display_name(bangla: Column | str, name: Column | str, id_: Column | str) -> Column:
    """Only null falls through here: a field that is present but empty is shown."""
    return F.coalesce(col(bangla), col(name), col(id_).cast("string"))


def chapter_label(title: Column | str, chapter_name: Column | str) -> Column:
    return first_of(title, chapter_name, default="")


def section_label(name: Column | str) -> Column:
    return first_of(name, default="")


def report_titles(name: Column | str, bangla: Column | str) -> tuple[Column, Column]:
    """(English, Bangla) report titles; a null name is an empty one."""
    empty = lambda c: F.coalesce(col(c), F.lit(""))
    return F.concat(F.lit(TITLE_PREFIX_EN), empty(name)), F.concat(empty(bangla), F.lit(TITLE_SUFFIX_BN))


def chapter_name(serial: Column | str, name: Column | str) -> Column:
    return F.concat(F.lit(CHAPTER_LABEL), col(serial).cast("string"), F.lit(": "), col(name))


def section_header(chapter_serial: Column | str, serial: Column | str, bangla: Column | str) -> Column:
    """``2.1 name``; a null name is spelled out."""
    return F.concat(col(chapter_serial).cast("string"), F.lit("."), col(serial).cast("string"), F.lit(" "), F.coalesce(col(bangla), F.lit("null")))


def strip(c: Column) -> Column:
    """Without white space of any script at both ends."""
    return F.regexp_replace(c, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def safe_name(name: Column | str, limit: int = 60) -> Column:
    return strip(F.translate(F.substring(F.coalesce(col(name), F.lit("unnamed")), 1, limit), "/\\:", "---"))


def commission_slug(serial: Column | str, name: Column | str) -> Column:
    title = F.substring(F.coalesce(col(name), F.lit("unknown")), 1, 40)
    return F.translate(F.concat(F.format_string("%02d", col(serial)), F.lit("-"), title), "/ ", "--")


def volume_slug(name: Column | str) -> Column:
    return strip(F.translate(F.substring(F.coalesce(col(name), F.lit("volume")), 1, 30), "/", "-"))


def pdf_prefix(file_name: Column | str) -> Column:
    return F.substring_index(col(file_name), "_", 1)


def target_path(commission: Column | str, volume: Column | str, pdf_name: Column | str, section: Column | str) -> Column:
    """commission/volume/prefix_name.pdf; a null volume directory is left out."""
    return F.concat_ws("/", col(commission), col(volume), F.concat(pdf_prefix(pdf_name), F.lit("_"), safe_name(section), F.lit(".pdf")))


def attachment_url(file_name: Column | str, base: str = PDF_BASE) -> Column:
    return F.when(nz(file_name).isNull(), F.lit("")).otherwise(F.concat(F.lit(base), col(file_name)))


def video_url(url: Column | str) -> Column:
    return F.concat(col(url), F.lit("?rel=0"))


def rewrite_path(path: Column | str) -> Column:
    """Old attachment addresses lead to the collection."""
    return F.regexp_replace(col(path), "^(" + "|".join(MOVED_PREFIXES) + ")", PDF_BASE)


def escape_attribute(c: Column | str) -> Column:
    """For use inside quotes; ``>`` stays."""
    out = col(c)
    for plain, written in (("&", "&amp;"), ('"', "&quot;"), ("'", "&#39;"), ("<", "&lt;")):
        out = F.replace(out, F.lit(plain), F.lit(written))
    return out


def line_breaks(c: Column | str) -> Column:
    return F.replace(col(c), F.lit("\n"), F.lit("<br>"))


def parse_route(hash_: Column | str, pages: Sequence[str] = PAGES) -> tuple[Column, Column]:
    """(page, id) of ``#/page/id``; no or an unknown page is home, no id is null."""
    given = F.coalesce(nz(hash_), F.lit("#/"))
    parts = F.split(F.regexp_replace(given, "^#/?", ""), "/", -1)
    page = F.coalesce(nz(F.get(parts, F.lit(0))), F.lit("home"))
    return F.when(page.isin(*pages), page).otherwise(F.lit("home")), nz(F.get(parts, F.lit(1)))


def notice_date(c: Column | str) -> Column:
    """dd-MM-yyyy, or null."""
    return F.try_to_date(col(c), "dd-MM-yyyy")


def upload_time(file_name: Column | str) -> Column:
    """When a file was uploaded, from the milliseconds in its name; null if it has none."""
    return F.timestamp_millis(nz(F.regexp_extract(col(file_name), r"_(\d{13})\.", 1)).cast("long"))


def decode_bool(c: Column | str) -> Column:
    """true and 1 only, in this case only."""
    return F.coalesce(col(c).cast("string").isin("true", "1"), F.lit(False))


def encode_bool(c: Column | str) -> Column:
    return truthy(c).cast("int")


def decode_upload(data_url: Column | str) -> Column:
    """The bytes behind ``base64,``, null when they can't be read."""
    c = col(data_url)
    at = F.locate("base64,", c)
    return F.try_to_binary(F.when(at > 0, F.substr(c, at + len("base64,"))).otherwise(F.substr(c, F.lit(len("base64,")))), F.lit("base64"))


def format_bytes(n: Column | str) -> Column:
    """With thousands separators, right-aligned to ten characters, never cut."""
    text = F.format_number(col(n), 0)
    return F.concat(F.repeat(F.lit(" "), F.greatest(F.lit(0), F.lit(10) - F.length(text))), text)


def authority_list(text: Column | str) -> Column:
    return F.split(F.regexp_replace(col(text), r"\s+", ""), ",", -1)


def has_any_authority(authenticated: Column | str, held: Column | str, wanted: Column) -> Column:
    return truthy(authenticated) & F.coalesce(F.arrays_overlap(col(held), wanted), F.lit(False))


def has_authority(authenticated: Column | str, held: Column | str, wanted: Column | str) -> Column:
    return truthy(authenticated) & F.coalesce(F.array_contains(col(held), wanted), F.lit(False))


def has_children(children: Column | str) -> Column:
    return F.coalesce(F.size(col(children)), F.lit(0)) > 0


def usable_pdf(has_pdf: Column | str, pdf_name: Column | str) -> Column:
    return truthy(has_pdf) & nz(pdf_name).isNotNull()


def section_kind(has_pdf: Column | str, pdf_name: Column | str) -> Column:
    return F.when(usable_pdf(has_pdf, pdf_name), F.lit("pdf")).otherwise(F.lit("text"))


def paragraph_kind(has_image: Column | str, file_name: Column | str) -> Column:
    return F.when(usable_pdf(has_image, file_name), F.lit("image")).otherwise(F.lit("text"))


def chapter_kind(children: Column | str) -> Column:
    return F.when(has_children(children), F.lit("branch")).otherwise(F.lit("leaf"))


def required_violations(rules: dict[str, Column]) -> Column:
    """Names of the rules whose condition isn't true."""
    return F.filter(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]), lambda x: x.isNotNull())


def contains_key(key: Column | str, *fields: Column | str) -> Column:
    """Whether any field holds the key literally, whatever the case; an empty or null key fits all."""
    k = F.lit(key) if isinstance(key, str) else key
    hit = F.lit(False)
    for f in fields:
        hit = hit | F.coalesce(F.contains(F.lower(col(f)), F.lower(k)), F.lit(False))
    return nz(k).isNull() | hit


def compose_bangla(c: Column | str) -> Column:
    """One spelling for letters that have two: the precomposed ones are taken apart."""
    out = col(c)
    for one, two in (("ড়", "ড়"), ("ঢ়", "ঢ়"), ("য়", "য়")):
        out = F.replace(out, F.lit(one), F.lit(two))
    return out


def language_name(code: Column | str) -> Column:
    table = F.create_map(*[F.lit(x) for pair in LANGUAGES.items() for x in pair])
    return F.try_element_at(table, col(code))
