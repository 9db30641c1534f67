"""Elements of HTML pages, found by one pass over their tags with a stack of the open ones.

No pattern here goes back over what it has read, so the time of a page grows with its length.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values of HTML: elements without content, those that end where the next of the same name begins, and
# those that hold others, whose end is the end of all that stands in them
VOID = "area|base|br|col|embed|hr|img|input|link|meta|param|source|track|wbr"
REPEATED = "p|li|dt|dd|td|th|tr|option"
HOLDERS = "div|section|article|form|table|ul|ol|dl|td|tr|li|p|body|main|nav"

_COMMENT = r"<!--(?:[^-]++|-(?!->))*+(?:-->|$)"
# a tag or a lone bracket, each with the text after it
_TOKEN = r"<(?:/?[A-Za-z][^<>]*+>)?+[^<]*+"
_OPENING = r"<[A-Za-z][^<>]*+>"
_NAME = r"^</?([A-Za-z][^\s/>]*+)[^<>]*+>"

Test = Callable[[Column], Column]


def let(value: Column, use: Test) -> Column:
    """``use(value)`` where the value is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute of an opening tag, in quotes or not; empty when there is none."""
    raw = F.regexp_extract(tag, rf"""(?i)\s{name}\s*=\s*("[^"]*+"|'[^']*+'|[^\s"'>]++)""", 1)
    return F.when(raw.startswith('"') | raw.startswith("'"), F.substr(raw, F.lit(2), F.char_length(raw) - 2)).otherwise(raw)


def has_class(tag: Column, *names: str) -> Column:
    """Whether an opening tag has all the classes."""
    found = F.split(attribute(tag, "class"), r"\s+")
    return F.when(tag.contains(names[0]), F.size(F.array_except(F.array(*map(F.lit, names)), found)) == 0).otherwise(False)


def has_id(tag: Column, name: str) -> Column:
    return F.when(tag.contains(name), attribute(tag, "id") == name).otherwise(False)


def is_named(tag: Column, name: str) -> Column:
    return tag.rlike(rf"(?i)^<{name}[\s/>]")


def last_number(text: Column) -> Column:
    """Last whole number in a text; null when there is none."""
    return F.try_element_at(F.regexp_extract_all(text, F.lit(r"\b\d++\b"), F.lit(0)), F.lit(-1))


def block(html: Column, test: Test) -> Column:
    """What stands inside the first element whose opening tag passes; empty when there is none.

    It ends at its own end, or with the page. Comments are left out.
    """

    def inside(page: Column) -> Column:
        opening = F.get(F.filter(F.regexp_extract_all(page, F.lit(_OPENING), F.lit(0)), test), F.lit(0))
        return let(opening, lambda tag: F.when(tag.isNull(), F.lit("")).otherwise(_until_own_end(
            F.substr(page, F.instr(page, tag) + F.char_length(tag)), F.regexp_extract(tag, _NAME, 1))))

    return let(F.regexp_replace(html, _COMMENT, ""), inside)


def _until_own_end(tail: Column, name: Column) -> Column:
    # cut before every tag of the same name; the first piece is inside, and so is the rest while tags are open
    pieces = F.split(F.concat(F.lit(" "), tail), F.concat(F.lit("(?i)(?=</?"), name, F.lit(r"[\s/>])")))
    start = F.struct(F.lit(1).alias("open"), F.lit(0).alias("inside"))

    def step(seen: Column, piece: Column) -> Column:
        change = F.when(piece.startswith("</"), -1).when(piece.startswith("<") & (seen["inside"] > 0), 1).otherwise(0)
        now = F.when(seen["open"] > 0, seen["open"] + change).otherwise(0)
        return F.struct(now.alias("open"), (seen["inside"] + F.when(now > 0, 1).otherwise(0)).alias("inside"))

    kept = F.aggregate(pieces, start, step, lambda seen: seen["inside"])
    return F.array_join(F.slice(pieces, F.lit(1), kept), "")


def _open_after(stack: Column, token: Column) -> Column:
    """Names of the open elements after a tag, none when the outermost has ended. An end closes the nearest open element
    of its name and all inside it; the end of a holder that is not open ends everything, any other is passed over."""
    name, size = token["name"], F.size(stack)
    back = F.array_position(F.reverse(stack), name).cast("int")  # from the top, 0: not open
    holder = name.rlike(f"^(?:{HOLDERS})$")
    none = F.array().cast("array<string>")
    closed = F.when((back == 0) & holder, none).when(back == 0, stack).otherwise(F.slice(stack, F.lit(1), size - back))
    # the end of an inline element is not the end of a holder inside it
    over = F.when(holder | (back <= 1), False).otherwise(F.array_join(
        F.slice(stack, size - back + 2, back - 1), " ").rlike(f"(?:^| )(?:{HOLDERS})(?:$| )"))
    same = name.rlike(f"^(?:{REPEATED})$") & (F.element_at(stack, F.lit(-1)) == name)
    opened = F.when(same & (size == 1), none).when(same, stack).otherwise(F.array_append(stack, name))
    return (
        F.when(name == "", stack).when(token["closes"], F.when(over, stack).otherwise(closed))
        .when(token["void"], stack).otherwise(opened)
    )


def _token(raw: Column) -> Column:
    name = F.lower(F.regexp_extract(raw, _NAME, 1))
    return let(name, lambda n: F.struct(
        raw.alias("raw"), n.alias("name"), raw.startswith("</").alias("closes"),
        (n.rlike(f"^(?:{VOID})$") | raw.rlike("^[^>]*+(?<=/)>")).alias("void")))


def items(inside: Column, test: Test) -> Column:
    """``array<struct<tag, text>>``: the elements of a block whose opening tags pass, in page order, with the text in them.

    An element ends at its own end, at the next element that passes, and where what it stands in ends.
    """
    tokens = F.regexp_extract_all(inside, F.lit(_TOKEN), F.lit(0))

    def parts(listed: Column) -> Column:
        passes = F.transform(listed, lambda raw: ~raw.startswith("</") & test(F.regexp_extract(raw, _OPENING, 0)))
        flagged = F.transform(passes, lambda is_item, at: F.when(is_item, at))
        return let(F.array_compact(flagged), lambda starts: F.transform(starts, lambda at, k: F.slice(
            listed, at + 1, F.coalesce(F.get(starts, k + 1), F.size(listed)) - at)))

    def element(part: Column) -> Column:
        start = F.struct(F.array().cast("array<string>").alias("stack"), F.lit(0).alias("kept"))

        def step(state: Column, token: Column) -> Column:
            after = F.when(state["kept"] == 0, F.array(token["name"])).otherwise(_open_after(state["stack"], token))
            ended = (state["kept"] > 0) & (F.size(state["stack"]) == 0)
            return F.when(ended, state).otherwise(F.struct(
                after.alias("stack"), (state["kept"] + 1).alias("kept")))

        def text(state: Column) -> Column:
            # the last tag that was read ended the element, if nothing is open
            count = state["kept"] - F.when(F.size(state["stack"]) == 0, 1).otherwise(0)
            return F.regexp_replace(F.array_join(F.slice(part, F.lit(1), count), ""), "</?[A-Za-z][^<>]*+>", "")

        return F.struct(
            F.regexp_extract(F.get(part, F.lit(0)), _OPENING, 0).alias("tag"),
            F.aggregate(F.transform(part, _token), start, step, text).alias("text"))

    return F.transform(let(tokens, parts), element)
