"""HTML to text and HTML tables to cells, both as built-in expressions."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.text import bind

# Named entities and the plain text they are written as; other names give their character.
ENTITIES = {
    "nbsp": " ",
    "lt": "<",
    "gt": ">",
    "quot": '"',
    "apos": "'",
    "rsquo": "'",
    "lsquo": "'",
    "rdquo": '"',
    "ldquo": '"',
    "copy": "(C)",
    "mdash": "--",
    "ndash": "-",
    "bull": "*",
    "hellip": "...",
    "eacute": "é",
    "egrave": "è",
    "uuml": "ü",
    "ouml": "ö",
    "auml": "ä",
    "szlig": "ß",
    "euro": "€",
    "pound": "£",
    "trade": "(TM)",
    "reg": "(R)",
    "middot": "*",
}

# Every pattern starts with a plain "<": the regex engine then skips text at the speed of a scan.
_HIDDEN = r"(?is)<(?:!--.*?--|(script|style|head)\b.*?</\1\s*|![^>]*)>"
_BREAKS = r"(?i)<(?:br|hr|/(?:tr|li|dt|dd|caption))\b[^>]*>"
_BLOCKS = (
    r"(?i)<(?:/?(?:p(?:re)?|d(?:iv|l)|table|[uo]l|section|a(?:rticle|ddress)|h(?:eader|tml)|fo(?:oter|rm)|nav|main|"
    r"b(?:lockquote|ody))\b[^>]*|/h[1-6]\s*)>"
)


# a pair of surrogates written as two references is one character
_HIGH, _LOW = r"#(?:5[56]\d{3}|[xX][dD][89abAB][0-9a-fA-F]{2});", r"#(?:5[67]\d{3}|[xX][dD][c-fC-F][0-9a-fA-F]{2});"
_REFERENCE = rf"&(?:{_HIGH}&{_LOW}|#\d+;|#[xX][0-9a-fA-F]+;|[A-Za-z][A-Za-z0-9]*;)"


def _names() -> Column:
    """All named references as one constant map; those of ``ENTITIES`` are written plainly."""
    every = {n[:-1]: c for n, c in html5.items() if n.endswith(";")} | ENTITIES
    return F.from_json(F.lit(json.dumps(every)), "map<string,string>")


def _code(ref: Column) -> Column:
    """Code of a numeric reference (``#65;``, ``#x41;``); -1 if it has too many digits."""
    hex = ref.rlike("^#[xX]")
    digits = F.regexp_extract(ref, "^#[xX]?0*([0-9a-fA-F]*);$", 1)
    digits = F.when(digits == "", "0").otherwise(digits)
    value = F.when(hex, F.conv(digits, 16, 10)).otherwise(F.conv(digits, 10, 10)).try_cast("int")
    return F.when(F.length(digits) <= 7, value).otherwise(-1)


def _char(code: Column) -> Column:
    """A code as a character; what is none (zero, surrogates, beyond U+10FFFF) becomes U+FFFD."""
    sound = ((code > 0) & (code < 0xD800)) | ((code > 0xDFFF) & (code <= 0x10FFFF))
    code = F.when(sound, code).otherwise(0xFFFD)
    return F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")


def _decoded(ref: Column, names: Column) -> Column:
    """What a reference stands for; an unknown name stays as it is."""
    body = F.substring(ref, 2, 100_000)
    low = F.regexp_extract(body, ";&(#.*)$", 1)
    first, second = _code(F.regexp_extract(body, "^(#[^;]*;)", 1)), _code(low)
    pair = (low != "") & first.between(0xD800, 0xDBFF) & second.between(0xDC00, 0xDFFF)
    joined = F.lit(0x10000) + (first - 0xD800) * 0x400 + (second - 0xDC00)
    number = F.when(pair, _char(joined)).when(low != "", F.concat(_char(first), _char(second))).otherwise(_char(first))
    named = F.coalesce(F.try_element_at(names, F.rtrim(body, F.lit(";"))), ref)
    return F.when(body.startswith("#"), number).otherwise(named)


def _entities(c: Column) -> Column:
    """Each reference that the text has is replaced once; what gives ``&`` comes last, so nothing is decoded twice."""
    found = F.transform(
        F.array_distinct(F.regexp_extract_all(c, F.lit(_REFERENCE), F.lit(0))),
        lambda ref: F.struct(ref.alias("ref"), _decoded(ref, _names()).alias("is")),
    )
    # longer references first: a pair before its halves
    ordered = F.array_sort(
        F.transform(found, lambda x: F.struct((x["is"] == "&").alias("last"), (-F.length(x["ref"])).alias("n"), x["ref"].alias("ref"), x["is"].alias("is")))
    )
    return F.reduce(ordered, c, lambda acc, x: F.replace(acc, x["ref"], x["is"]))


def unescape(c: Column) -> Column:
    """Character references to characters; only text that has one pays for it.

    The commonest is replaced beforehand: what it gives is no part of another reference.
    """
    spaced = bind(c, lambda t: _replaced(t, "&nbsp;", ENTITIES["nbsp"]))
    return bind(spaced, lambda t: F.when(t.contains("&"), _entities(t)).otherwise(t))


def _replaced(c: Column, old: str, new: str) -> Column:
    """``replace`` where there is something to replace: to look for it costs a fraction of a replacement in vain."""
    return F.when(c.contains(old), F.replace(c, F.lit(old), F.lit(new))).otherwise(c)


def html_to_text(c: Column) -> Column:
    """Readable text of an HTML body.

    Blocks are set apart by an empty line, rows and breaks by a line end, headings carry ``#`` marks,
    list items a ``*``. Cells of one row are not separated: their text follows the source's own
    spacing. Links, images and emphasis leave only their text.
    """
    t = F.regexp_replace(c, _HIDDEN, "")
    t = F.regexp_replace(t, "[ \\t\\r\\n\\f]+", " ")
    t = F.regexp_replace(t, _BREAKS, "\n")
    t = F.regexp_replace(t, _BLOCKS, "\n\n")
    t = bind(t, lambda x: F.when(x.rlike("<[hH][1-6]"), _headings(x)).otherwise(x))
    t = F.regexp_replace(t, r"<[lL][iI]\b[^>]*>", "\n* ")
    t = F.regexp_replace(t, r"<[A-Za-z/][^>]*>", "")
    t = bind(unescape(t), lambda x: _replaced(x, "\u00a0", " "))
    t = F.regexp_replace(t, " +\\n *|\\n +", "\n")
    t = F.regexp_replace(t, "\\n{3,}", "\n\n")
    return F.btrim(t, F.lit(" \n"))


def _headings(c: Column) -> Column:
    c = F.regexp_replace(c, r"<[hH]([1-6])\b[^>]*>", "\n\n\u0001$1")
    for level in range(1, 7):
        c = F.replace(c, F.lit(f"\u0001{level}"), F.lit("#" * level + " "))
    return c


def _cell_text(c: Column) -> Column:
    bare = F.regexp_replace(c, r"(?is)<!--.*?-->|<[A-Za-z/][^>]*>", " ")
    return F.btrim(F.regexp_replace(F.replace(unescape(bare), F.lit("\u00a0"), F.lit(" ")), "\\s+", " "))


#: Pieces of a body that are gone through at a time: what grows is copied once for each of these, not for each piece.
_PIECES = 256


def _table_sources(html: str) -> Column:
    """Own markup of every table in document order, whatever the nesting.

    The body is cut at table tags. Each piece belongs to the innermost open table with its markup and
    to every table around that one as bare text, so a nested table shows as text in its outer cell.
    One pass numbers the tables and says whose each piece is; sorted by table, a table's pieces are a run. The work is
    that of the pieces times the depth of nesting. Where every piece that begins a table ends it too, none is nested, and
    those pieces are the tables.
    """
    part = "array<struct<t:int,n:int,s:string>>"
    pieces = F.split(F.col(html), r"(?i)(?=<table\b)|(?<=</table>)")

    def blocks(p: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(p) - 1) / _PIECES).cast("int")), lambda b: F.slice(p, b * _PIECES + 1, _PIECES))

    def begins(piece: Column) -> Column:
        return piece.rlike(r"(?i)^<table\b")

    def ends(piece: Column) -> Column:
        return piece.rlike("(?i)</table>$")

    def place(a: Column, piece: Column) -> Column:
        def told(m: Column) -> Column:
            begins, ends = m["begins"], m["ends"]
            own = F.when(begins, F.array_append(a["open"], a["made"])).otherwise(a["open"])
            left = F.when(begins & ~ends, own).when(~begins & ends, F.slice(a["open"], 1, F.greatest(F.size(a["open"]) - 1, F.lit(0)))).otherwise(a["open"])
            bare = F.regexp_replace(piece, "<[^>]*>", " ")
            shown = F.transform(own, lambda t, i: F.struct(t.alias("t"), a["n"].alias("n"), F.when(i == F.size(own) - 1, piece).otherwise(bare).alias("s")))
            return F.struct(left.alias("open"), (a["made"] + begins.cast("int")).alias("made"), (a["n"] + 1).alias("n"), F.concat(a["parts"], shown).alias("parts"))

        return bind(F.struct(begins(piece).alias("begins"), ends(piece).alias("ends")), told)

    def block(a: Column, some: Column) -> Column:
        fresh = F.struct(a["open"].alias("open"), a["made"].alias("made"), a["n"].alias("n"), F.array().cast(part).alias("parts"))
        done = F.reduce(some, fresh, place)
        return bind(done, lambda r: F.struct(r["open"].alias("open"), r["made"].alias("made"), r["n"].alias("n"), F.array_append(a["parts"], r["parts"]).alias("parts")))

    start = F.struct(F.array().cast("array<int>").alias("open"), F.lit(0).alias("made"), F.lit(0).alias("n"), F.array().cast(f"array<{part}>").alias("parts"))

    def tables(ps: Column) -> Column:
        first = F.filter(F.sequence(F.lit(0), F.size(ps) - 1), lambda i: (i == 0) | (F.get(ps, i)["t"] != F.get(ps, i - 1)["t"]))
        return bind(first, lambda at: F.transform(at, lambda b, k: F.array_join(F.transform(F.slice(ps, b + 1, F.coalesce(F.get(at, k + 1), F.size(ps)) - b), lambda x: x["s"]), "")))

    def nested(p: Column) -> Column:
        parts = F.sort_array(F.flatten(F.reduce(blocks(p), start, block)["parts"]))
        return bind(parts, lambda ps: F.when(F.size(ps) > 0, tables(ps)).when(ps.isNotNull(), F.array().cast("array<string>")))

    def each(p: Column) -> Column:
        return bind(F.filter(p, begins), lambda own: F.when(F.forall(own, ends), own).otherwise(nested(p)))

    return bind(pieces, each)


def html_cells(html: str) -> Column:
    """All tables of an HTML column as ``array<array<array<string>>>`` (table, row, cell)."""
    return F.transform(
        _table_sources(html),
        lambda table: F.filter(
            F.transform(
                F.split(table, r"(?i)<tr\b[^>]*>"),
                lambda row: F.transform(
                    F.regexp_extract_all(
                        F.concat(row, F.lit("</td>")),
                        F.lit(r"(?is)<t[dh]\b[^>]*>(.*?)(?=</t[dh]>|<t[dh]\b)"),
                        F.lit(1),
                    ),
                    _cell_text,
                ),
            ),
            lambda cells: F.size(cells) > 0,
        ),
    )


def html_tables(df: DataFrame, id: str, html: str) -> DataFrame:
    """One row per cell: ``(id, table_idx, row_idx, col_idx, text)``."""
    return (
        df.where(F.col(html).rlike(r"(?i)<table\b"))
        .select(id, F.posexplode(html_cells(html)).alias("table_idx", "_rows"))
        .select(id, "table_idx", F.posexplode("_rows").alias("row_idx", "_cells"))
        .select(id, "table_idx", "row_idx", F.posexplode("_cells").alias("col_idx", "text"))
    )
