"""String functions as Column expressions (all stay in the JVM)."""

from __future__ import annotations

import html
import json
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from scriptorium.functions import constants as C


ENTITY = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]*;?)"
CLOSED = ENTITY.replace(";?", ";")
#: Names that count without a semicolon too, longest first.
BARE = sorted((n for n in html.entities.html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
REPLACED = {n: html.unescape(f"&#{n};") for n in range(0x80, 0xA0)}


def _numbered(entity: Column) -> Column:
    """The character of a numeric entity, by the rules of HTML for numbers that name none."""
    digits = F.regexp_extract(entity, "([0-9a-fA-F]+);?$", 1)
    number = F.when(F.char_length(F.regexp_replace(digits, "^0+", "")) > 12, F.lit(1 << 40)).when(entity.rlike("^&#[xX]"), F.conv(digits, 16, 10).cast("long")).otherwise(F.conv(digits, 10, 10).cast("long"))
    old = F.try_element_at(F.create_map(*[F.lit(x) for pair in REPLACED.items() for x in pair]), number.cast("int"))
    none = (number == 0) | number.between(0xD800, 0xDFFF) | (number > 0x10FFFF)
    gone = number.between(1, 8) | number.between(0xE, 0x1F) | (number == 0xB) | (number == 0x7F) | number.between(0xFDD0, 0xFDEF) | ((number % 65536) >= 65534)
    return F.when(none, "\ufffd").when(old.isNotNull(), old).when(gone, "").otherwise(F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32"))


def _named(entity: Column, bare: bool = True) -> Column:
    """The characters of a named entity; if bare, a name without semicolon by its longest known beginning; else as it is."""
    table = F.from_json(F.lit(json.dumps(html.entities.html5)), "map<string,string>")
    whole = F.try_element_at(table, F.substr(entity, F.lit(2)))
    if not bare:
        return F.coalesce(whole, entity)
    start = F.regexp_extract(entity, f"^&({'|'.join(BARE)})", 1)
    return F.coalesce(whole, F.when(start != "", F.concat(F.try_element_at(table, start), F.substr(entity, F.char_length(start) + 2))), entity)


def unescape_entities(text: Column, bare: bool = True) -> Column:
    """Named and numeric entities to characters, each once; unless bare, only those that a semicolon ends."""
    pattern = ENTITY if bare else CLOSED

    def character(e):
        common = reduce(lambda c, x: c.when(e == x[0], x[1]), C.ENTITIES.items(), F.when(e == "&amp;", "&"))
        return common.when(e.startswith("&#"), _numbered(e)).otherwise(_named(e, bare))

    found = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), character)
    whole = F.array_join(F.zip_with(F.split(text, pattern, -1), found, lambda t, e: F.concat(t, F.coalesce(e, F.lit("")))), "")
    return F.when(text.rlike(pattern), whole).otherwise(text)


def html_to_text(html: Column, blocks: str = "p|div|h[1-6]|li|tr", bare: bool = True) -> Column:
    """Line breaks for br and for the ends of block elements, blanks for other tags, entities as characters.

    Entities are read as HTML does, without a semicolon too; unless bare, these stay as they are.
    """
    text = F.regexp_replace(html, r"(?i)<br\s*/?>", "\n")
    text = F.regexp_replace(text, rf"(?i)</(?:{blocks})\s*>", "\n")
    text = F.when(html.contains("<"), F.regexp_replace(text, r"<[^>]+>", " ")).otherwise(html)
    return F.when(html.contains("&"), unescape_entities(text, bare)).otherwise(text)


def html_to_text_metadata(html: Column, bare: bool = True) -> Column:
    return html_to_text(html, "p|div|h[1-6]|li|tr|blockquote|ul|ol", bare)


def clean_text(text: Column) -> Column:
    """No-break spaces as blanks, white space collapsed, ends stripped."""
    return F.trim(F.regexp_replace(F.replace(text, F.lit(" "), F.lit(" ")), r"(?U)\s+", " "))


def clean_text_block(text: Column) -> Column:
    """As clean_text, but lines stay: no blanks around line ends, at most one empty line, single blanks."""
    text = F.regexp_replace(F.replace(text, F.lit(" "), F.lit(" ")), r"[ \t]*\n[ \t]*", "\n")
    text = F.regexp_replace(F.regexp_replace(text, r"\n{3,}", "\n\n"), r"[ \t]{2,}", " ")
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def normalize_title(text: Column) -> Column:
    return F.lower(clean_text(text))


def heading_title(text: Column) -> Column:
    """A heading without Markdown emphasis."""
    return clean_text(F.regexp_replace(text, r"[*_`]+", ""))


def label_title(text: Column) -> Column:
    """The form in which headings are looked up in the title families."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.trim(text)), r"[*_`#]+", ""), r"(?U)\s+", " "))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"(?U)\S+"))


def claim_key(text: Column) -> Column:
    """Lower case, punctuation as blanks, white space collapsed."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(text), r"(?U)[^\w\s]", " "), r"(?U)\s+", " "))


def hits(text: Column, patterns: list[str]) -> Column:
    """How many of the patterns match."""
    return reduce(lambda a, b: a + b, [text.rlike(p).cast("int") for p in patterns])


def is_boilerplate(text: Column) -> Column:
    """Two pattern hits; or one in at most 40 words; or at most 20 words that name an ISSN or DOI."""
    n, words, low = hits(text, [f"(?i){p}" for p in C.BOILERPLATE]), word_count(text), F.lower(text)
    return (n >= 2) | ((n >= 1) & (words <= 40)) | ((words <= 20) & (low.contains("issn") | low.contains("doi")))


def is_affiliation(text: Column, words: list[str] | None = None) -> Column:
    """Holds one of the words anywhere, inside other words too."""
    return F.lower(text).rlike("|".join(words or C.AFFILIATIONS))


def is_reference_entry(text: Column) -> Column:
    """At least half of the lines that aren't empty begin with an author and show two signals."""
    lines = F.filter(F.transform(F.split(text, "\n"), F.trim), lambda x: x != "")
    good = F.filter(lines, lambda x: x.rlike(C.REFERENCE_START) & (hits(x, C.REFERENCE_SIGNALS) >= 2))
    return (F.size(good) > 0) & (F.size(good) / F.size(lines) >= 0.5)


def is_metadata_reference(text: Column) -> Column:
    """The first line begins with an author and the text shows two signals."""
    return F.trim(F.substring_index(text, "\n", 1)).rlike(C.REFERENCE_START) & (hits(text, C.METADATA_REFERENCE_SIGNALS) >= 2)


def is_person(text: Column) -> Column:
    name = F.trim(F.regexp_replace(clean_text(text), r"^[ ,;]+|[ ,;]+$", ""))
    return word_count(name).between(2, 4) & ~is_affiliation(name, C.METADATA_AFFILIATIONS) & ~name.rlike(C.NUMBERED_HEADING) & name.rlike(C.PERSON)


def page_of(block_id: Column) -> Column:
    """The page number in a block's id, else null."""
    return F.nullif(F.regexp_extract(block_id, r"^/page/(\d+)", 1), F.lit("")).try_cast("int")


def nullable(text: Column) -> Column:
    """Trimmed, null where empty."""
    return F.nullif(F.trim(text), F.lit(""))


def preview(text: Column, most: int = 240) -> Column:
    """White space collapsed, cut to `most` characters with an ellipsis."""
    flat = clean_text(text)
    return F.when(F.char_length(flat) > most, F.concat(F.substring(flat, 1, most - 3), F.lit("..."))).otherwise(flat)


def article_quintile(start: Column, end: Column, length: Column) -> Column:
    """The fifth of the article that the middle of a span falls in; null without length."""
    at = (start + end) / 2 / length
    return F.when(length <= 0, None).when(at < 0.2, "first 20%").when(at < 0.4, "second 20%").when(at < 0.6, "third 20%").when(at < 0.8, "fourth 20%").otherwise("last 20%")


def chunk_id(paper_id: Column, section_title: Column, chunk_index: Column) -> Column:
    return F.sha2(F.concat_ws("\n", paper_id, section_title, chunk_index.cast("string")), 256)


def citation_label(authors: Column, year: Column, paper_id: Column) -> Column:
    """Surname of the first author, et al. for more, else from the paper's id; then the year."""
    parts = F.filter(F.transform(F.split(F.element_at(authors, 1), r"\s+"), lambda p: F.regexp_replace(p, "^,+|,+$", "")), lambda p: p != "")
    surname = F.coalesce(F.try_element_at(parts, F.lit(-1)), F.element_at(authors, 1))
    suffix = F.trim(F.translate(F.regexp_replace(paper_id, "^[^_]*_", ""), "-_", "  "))
    name = F.when(F.coalesce(F.size(authors), F.lit(0)) <= 0, F.coalesce(F.nullif(suffix, F.lit("")), paper_id)).when(F.size(authors) == 1, surname).otherwise(F.concat(surname, F.lit(" et al.")))
    when = F.coalesce(year.cast("string"), F.nullif(F.regexp_extract(paper_id, r"^(\d{4})[_-]", 1), F.lit("")), F.lit("n.d."))
    return F.concat(name, F.lit(", "), when)


def json_object(reply: Column) -> Column:
    """The outermost braces of a model's reply, fences and prose left out; null if none."""
    return F.nullif(F.regexp_extract(reply, r"(?s)\{.*\}", 0), F.lit(""))


QUOTED = r""""(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*'"""


def literal_as_json(text: Column) -> Column:
    """Python literals as those of JSON and no comma before a closing bracket, outside quoted strings only."""
    parts = F.regexp_extract_all(text, F.lit(rf"(?s){QUOTED}|[^\"']+|[\"']"), F.lit(0))

    def plain(part):
        out = part
        for word, other in (("True", "true"), ("False", "false"), ("None", "null")):
            out = F.regexp_replace(out, rf"\b{word}\b", other)
        return F.when(part.rlike("^[\"']"), part).otherwise(F.regexp_replace(out, r",(\s*[}\]])", "$1"))

    return F.array_join(F.transform(parts, plain), "")


def parse_reply(reply: Column, schema: str) -> Column:
    """A reply's object: as JSON if it is that, else with single quotes and Python literals; null where it can't be read."""
    text = json_object(reply)
    loose = F.from_json(literal_as_json(text), schema, {"mode": "PERMISSIVE", "allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true"})
    return F.when(F.try_parse_json(text).isNotNull(), F.from_json(text, schema)).otherwise(loose)


def reply_field(reply: Column, name: str) -> Column:
    """A string field of a reply that is no JSON: up to the first quote that a comma or brace follows, else to the end."""
    rest = F.nullif(F.regexp_extract(reply, rf'(?s)"{name}"[^:]*:[^"]*"(.*)', 1), F.lit(""))
    closed = F.regexp_extract(rest, r'(?s)^((?:.*?[^\\])??)"\s*[,}]', 1)
    return F.when(rest.rlike(r'(?s)^(?:.*?[^\\])??"\s*[,}]'), closed).otherwise(F.trim(F.regexp_replace(F.rtrim(rest), r"\}+$", "")))


def summary_section(markdown: Column) -> Column:
    """The body under the synthesized summary heading, else the whole text."""
    body = stripped(F.regexp_extract(markdown, r"(?ms)^## Synthesized Summary\s*$\n+(.*?)(?=^##\s|\z)", 1))
    return F.coalesce(F.nullif(body, F.lit("")), stripped(markdown))


def stripped(text: Column) -> Column:
    """Without white space at either end, line ends included."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def duration(seconds: Column) -> Column:
    s = seconds.cast("long")
    h, m, r = F.floor(s / 3600), F.floor(s / 60) % 60, s % 60
    return F.when(h > 0, F.format_string("%dh %dm %ds", h, m, r)).when(m > 0, F.format_string("%dm %ds", m, r)).otherwise(F.format_string("%ds", r))
