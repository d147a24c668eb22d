"""Wiki pages: XML to title and text, link targets, name spaces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatterscope import constants as C

# Fixed value: a schema that takes only what tells a broken page.
PAGE_SCHEMA = "_corrupt_record STRING"
BETWEEN = "\x01"
LINK = r"\[\[.*?\]\]"


def parse_page_xml(xml: Column) -> Column:
    """Struct (title in lower case, text); NULL fields where the XML is broken or has none.

    Title and text are what the first element with that word in its name begins with, at any depth.  One
    pass tells whether the XML is whole, which XPath needs, and one XPath finds both: a text node is never
    empty, and the character between them cannot stand in XML.
    """
    valid = F.from_xml(xml, F.lit(PAGE_SCHEMA), {"mode": "PERMISSIVE"})["_corrupt_record"].isNull()
    first = "(//*[contains(name(), '{}')])[1]/text()[1]"
    path = f"concat({first.format('title')}, '{BETWEEN}', {first.format('text')})"
    both = F.when(xml.isNotNull() & valid, F.split(F.xpath_string(xml, F.lit(path)), BETWEEN, 2))

    def fields(parts: Column) -> Column:
        own = [F.nullif(F.get(parts, F.lit(k)), F.lit("")) for k in (0, 1)]
        return F.struct(F.lower(own[0]).alias("title"), own[1].alias("text"))

    return F.transform(F.array(both), fields).getItem(0)


def parsed_pages(messages: DataFrame, xml: str, *keep: str) -> DataFrame:
    """``keep``, title, text of XML pages, each parsed once whatever is made of them: what a generator
    gives is not computed again in a filter above it."""
    return messages.select(*keep, F.inline(F.array(parse_page_xml(F.col(xml)))))


def page_id(title: Column) -> Column:
    """A page's id follows from its title, so a replayed page keeps its id."""
    return F.sha2(title, 256)


def in_article_namespace(title: Column) -> Column:
    lowered = F.lower(title)
    excluded = F.lit(False)
    for space in C.PAGE_NAMESPACES:
        excluded = excluded | F.contains(lowered, F.lit(space))
    return ~excluded


def extract_links(text: Column, strict_reference: bool = False) -> Column:
    """Targets of ``[[target|label]]`` links.

    Targets are in lower case like titles, and those in the left-out name spaces are dropped;
    ``strict_reference`` keeps case and drops none.
    """
    found = F.regexp_extract_all(text, F.lit(LINK), F.lit(0))
    targets = F.transform(
        found,
        lambda x: F.substring_index(F.ltrim(F.rtrim(x, F.lit("]")), F.lit("[")), "|", 1),
    )
    if strict_reference:
        return targets
    spaces = [s.rstrip(":") for s in C.PAGE_NAMESPACES]

    def wanted(target: Column) -> Column:
        space = F.substring_index(target, ":", 1)
        listed = F.lit(False)
        for s in spaces:
            listed = listed | F.contains(space, F.lit(s))
        return ~(F.contains(target, F.lit(":")) & listed)

    return F.filter(F.transform(targets, F.lower), wanted)
