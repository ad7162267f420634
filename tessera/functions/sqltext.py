"""Join clauses out of SQL text, as Catalyst expressions over one row.

Nothing here parses SQL into a tree.  The text of a statement is reduced, inside
its own row, until plain regular expressions can read the join clauses:

1. comments vanish, string literals and quoted identifiers are shifted into the
   Unicode private-use area, so that no later pattern can match inside them;
2. parenthesised groups are taken out innermost first.  A group with a SELECT or
   a JOIN becomes a *scope* of its own, any other one only changes its brackets;
3. each scope is cut at set operators, its FROM body at commas and join keywords.

Everything here works inside one row.  Nesting depth is measured per statement, so
there is no limit on it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.text import WHITESPACE

# Private-use marks.  Input text is cleared of this block first.
OPEN, CLOSE = "\ue000", "\ue001"  # brackets of an ordinary group
REF_OPEN, REF_CLOSE = "\ue002", "\ue003"  # reference to a lifted scope
COMMA = "\ue005"  # comma inside an ordinary group
HUSH = "\ue006"  # ends a keyword that must not be read as one
CUT, WORD_END = "\ue008", "\ue009"  # around the word between two sources
SUBSCRIPT = "\ue00a"  # bracket right behind a name: an element, no column
DEPTH = "\ue007"  # one per and/or/bracket level above an equality
_ASCII = "".join(map(chr, range(1, 128)))
_AS_IDENT = "".join(chr(0xE100 + i) for i in range(1, 128))
_AS_LITERAL = "".join(chr(0xE200 + i) for i in range(1, 128))
_PRIVATE = "[\ue000-\ue2ff]"

# Template parameter and the start of a further DDL statement.
TEMPLATE_PARAMETER = r"\{\{[^{}]+\}\}"
DDL_START = (
    r"(?i)(?:^|\s)(?=(?:create|drop|alter|truncate)\s+(?:or\s+replace\s+)?(?:view|table)\b)"
)

_TOKEN = (
    r"'[^']*+(?:''[^']*+)*+(?:'|$)"
    r'|"[^"]*+(?:"|$)'
    r"|\[[^\]]*+(?:\]|$)"
    r"|`[^`]*+(?:`|$)"
    r"|--[^\n]*+"
    r"|/\*[\s\S]*?(?:\*/|$)"
)
_TOKEN_START = r"['\"\[`]|--|/\*"
_SUBSCRIPT = (
    r"(?i)(?<=[\p{L}\p{N}_$#@\]\"`])(?<!\b(?:on|and|or|not|join|from|select|by|in|as|where|having|when|then|else"
    r"|set|into|using|between|like|over|update|apply))\["
)
_GROUP = r"\([^()]*\)"
_SCOPE_WORD = r"(?i)\b(?:select|join)\b"
_HUSHED_WORDS = (
    r"(?i)\b(from|where|group|having|order|limit|on|union|intersect|except|minus"
    r"|qualify|window|offset|fetch)\b"
)
_SET_OPERATOR = r"(?i)\b(?:union|intersect|except|minus)\b(?:\s+(?:all|distinct)\b)?"
_SELECT_FROM = r"(?i)\bselect\b.*?\bfrom\b(.*)$"
_BODY_END = (
    r"(?i)\b(?:where|group\s+by|having|order\s+by|limit|qualify|window|offset"
    r"|fetch|lateral\s+view|connect\s+by|start\s+with|option|for\s+xml)\b"
)
_JOIN_WORD = (
    r"(?i)(?:\bnatural\s+)?(?:\b(?:left|right|full)\s+(?:(?:outer|semi|anti|inner)\s+)?"
    r"|\b(?:inner|cross|outer|semi|anti)\s+)?(?:\b(?:hash|merge|loop|remote)\s+)?\bjoin\b"
)
_CUT = "(?i)(?:,|" + _JOIN_WORD[4:] + ")"
_WORD = r"[\p{L}_@#\ue100-\ue17f][\p{L}\p{N}_$#@\ue100-\ue17f]*+"
_TABLE = (
    r"(?i)^\s*(?:lateral\s+|only\s+)?("
    + _WORD
    + r"(?:\.{1,2}"
    + _WORD
    + r")*+)(?!\s*\ue000)(?:\s+(?:as\s+)?((?!(?:on|using|with|where|tablesample|pivot|unpivot"
    r"|cross|outer|inner|left|right|full|natural|lateral|for|option|set|join|as|apply"
    r"|match_recognize|order|group|limit|union)\b)"
    + _WORD
    + r"))?"
)
_COLUMN = (
    r"(?!(?:null|true|false|current_date|current_time|current_timestamp|default)\b)"
    + _WORD
    + r"(?:\."
    + _WORD
    + r")*+"
)
_EQUALITY = (
    r"(?i)(?:^|\b(?:and|or|not|when|then|else)\b|[\ue000\ue005])\s*("
    + _COLUMN
    + r")\s*=(\ue007*)(?![=>])\s*("
    + _COLUMN
    + r")(?=\s*(?:$|\b(?:and|or|then|when|else|end)\b|[\ue001\ue005]))"
)


def cut(text: Column, pattern: str) -> Column:
    """``split`` by a pattern that is compiled once per task instead of once per row."""
    return F.split(F.regexp_replace(text, pattern, CUT), CUT)


def _splice(text: Column, pattern: str, render) -> Column:
    """``text`` with each match of ``pattern`` replaced by ``render(match, index)``."""
    marked = F.regexp_replace(text, pattern, f"{CUT}$0{WORD_END}")
    pieces = F.transform(
        F.split(marked, CUT),
        lambda piece, i: F.when(
            F.contains(piece, F.lit(WORD_END)),
            F.concat(
                render(F.substring_index(piece, WORD_END, 1), i - 1),
                F.substring_index(piece, WORD_END, -1),
            ),
        ).otherwise(piece),
    )
    return F.array_join(pieces, "")


def _mentions(text: Column, *words: str) -> Column:
    """Cheap test, without a pattern, that spares most rows a costly step."""
    low = F.lower(text)
    found = F.contains(low, F.lit(words[0]))
    for word in words[1:]:
        found = found | F.contains(low, F.lit(word))
    return found


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, also inside a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def decode(text: Column) -> Column:
    """Shifted literals and identifiers back to plain text."""
    return F.when(
        text.rlike("[\ue100-\ue2ff]"), F.translate(text, _AS_IDENT + _AS_LITERAL, _ASCII + _ASCII)
    ).otherwise(text)


def readable(text: Column) -> Column:
    """Condition text for people: brackets and commas restored, one blank between words."""
    spaced = F.regexp_replace(
        F.replace(text, F.lit(DEPTH), F.lit("")), r"(?<![<>!=:])\s*=(?![>=])\s*", " = "
    )
    full = F.regexp_replace(spaced, f"{REF_OPEN}[0-9]+{REF_CLOSE}", "(…)")
    full = F.replace(full, F.lit("_" + HUSH), F.lit(""))
    full = F.regexp_replace(full, rf"(?<={OPEN})\s+|\s+(?=[{CLOSE}{COMMA}])", "")
    full = F.translate(
        F.regexp_replace(full, rf"{COMMA}\s*", f"{COMMA} "),
        _AS_IDENT + _AS_LITERAL + OPEN + CLOSE + COMMA + SUBSCRIPT,
        _ASCII + _ASCII + "(),[",
    )
    return F.trim(
        F.regexp_replace(
            F.when(spaced.rlike(_PRIVATE), full).otherwise(spaced), r"\s+", " "
        )
    )


def fill_templates(sql: Column) -> Column:
    """``{{ parameter }}`` -> 1; also clears the private-use block used below."""
    filled = F.when(
        F.contains(sql, F.lit("{{")), F.regexp_replace(sql, TEMPLATE_PARAMETER, "1")
    ).otherwise(sql)
    return F.regexp_replace(filled, _PRIVATE, " ")


def shield(sql: Column) -> Column:
    """Drop comments, shift literals and quoted identifiers out of reach of patterns."""

    def render(token: Column, _index: Column) -> Column:
        return (
            F.when(F.startswith(token, F.lit("'")), F.translate(token, _ASCII, _AS_LITERAL))
            .when(F.startswith(token, F.lit("--")) | F.startswith(token, F.lit("/*")), F.lit(" "))
            .otherwise(
                F.translate(
                    F.regexp_replace(token, r'^["\[`]|["\]`]$', ""), _ASCII, _AS_IDENT
                )
            )
        )

    indexed = F.when(
        F.contains(sql, F.lit("[")), F.regexp_replace(sql, _SUBSCRIPT, SUBSCRIPT)
    ).otherwise(sql)
    return F.when(indexed.rlike(_TOKEN_START), _splice(indexed, _TOKEN, render)).otherwise(indexed)


def tidy(shielded: Column) -> Column:
    """One blank between words, no blanks around the dots of quoted names."""
    flat = F.regexp_replace(shielded, WHITESPACE + "+", " ")
    dotted = F.regexp_replace(
        flat, r"(?<=[\ue100-\ue17f])\s*\.\s*|\s*\.\s*(?=[\ue100-\ue17f])", "."
    )
    flat = F.when(shielded.rlike("[\ue100-\ue17f]"), dotted).otherwise(flat)
    compared = F.regexp_replace(
        flat, r"(?i)\bdistinct from\b", f"distinct_{HUSH} from_{HUSH}"
    )
    return F.when(_mentions(flat, "distinct from"), compared).otherwise(flat)


def statements(tidied: Column) -> Column:
    """Array of non-blank statements: cut at ``;`` and before each further DDL verb."""
    pieces = F.flatten(
        F.transform(
            F.split(tidied, ";"),
            lambda s: F.when(
                _mentions(s, "create", "drop", "alter", "truncate"), cut(s, DDL_START)
            ).otherwise(F.array(s)),
        )
    )
    return F.filter(pieces, lambda s: F.trim(s) != "")


def nesting_depth(statement: Column) -> Column:
    """Deepest level of parentheses in the statement."""
    marks = F.filter(
        F.split(F.regexp_replace(statement, "[^()]", ""), ""), lambda m: m != ""
    )
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("top"))

    def step(acc: Column, mark: Column) -> Column:
        now = acc["now"] + F.when(mark == "(", 1).otherwise(-1)
        return F.struct(now.alias("now"), F.greatest(acc["top"], now).alias("top"))

    deepest = F.aggregate(marks, start, step, lambda acc: acc["top"])
    return F.when(F.contains(statement, F.lit("(")), deepest).otherwise(0)


def _chain(index: Column, size: Column) -> Column:
    """Levels above operand ``index`` in a left-deep chain of ``size`` operands."""
    return (
        F.when(size == 1, F.lit(0)).when(index == 0, size - 1).otherwise(size - index)
    )


def mark_depth(condition: Column, extra: int) -> Column:
    """Append one mark per boolean level to each ``=``.

    Equalities are later taken level by level, shallowest first, which decides the
    primary one of a composite key.
    """
    ranged = F.when(
        _mentions(condition, "between"),
        F.regexp_replace(condition, r"(?i)\bbetween\b(.*?)\band\b", f"between$1and_{HUSH}"),
    ).otherwise(condition)

    def one_or(part: Column, i: Column, n_or: Column) -> Column:
        ands = cut(part, r"(?i)\band\b")

        def one_and(operand: Column, j: Column, n_and: Column) -> Column:
            levels = (
                _chain(i, n_or)
                + _chain(j, n_and)
                + F.when(operand.rlike(r"(?i)^\s*not\b"), 1).otherwise(0)
                + F.lit(extra)
            )
            return F.trim(
                F.replace(operand, F.lit("="), F.concat(F.lit("="), F.repeat(F.lit(DEPTH), levels)))
            )

        return let(
            ands,
            lambda a: F.array_join(
                F.transform(a, lambda operand, j: one_and(operand, j, F.size(a))), " AND "
            ),
        )

    ors = cut(ranged, r"(?i)\bor\b")
    chained = let(
        ors,
        lambda o: F.array_join(F.transform(o, lambda p, i: one_or(p, i, F.size(o))), " OR "),
    )
    alone = F.replace(condition, F.lit("="), F.lit("=" + DEPTH * extra)) if extra else condition
    return F.when(condition.rlike(r"(?i)\b(?:and|or|not)\b"), chained).otherwise(F.trim(alone))


def _ordinary(inner: Column) -> Column:
    """Content of a bracket group that is no scope, made inert for later patterns."""
    marked = F.when(F.contains(inner, F.lit("=")), mark_depth(inner, 1)).otherwise(inner)
    hushed = F.regexp_replace(marked, _HUSHED_WORDS, "$1_" + HUSH)
    return F.concat(F.lit(OPEN), F.translate(hushed, ",", COMMA), F.lit(CLOSE))


def peel(statement: Column, depth: Column) -> Column:
    """``struct(text, scopes)``: the statement without its groups, and the lifted scopes.

    A scope is ``struct(level, id, text)``; an outer scope has a higher level than
    the ones it refers to.
    """
    none = F.array().cast("array<struct<level:int,id:int,text:string>>")
    start = F.struct(statement.alias("text"), none.alias("scopes"), F.lit(0).alias("n"))

    def inside(group: Column) -> Column:
        return F.substring(group, F.lit(2), F.length(group) - 2)

    def step(acc: Column, level: Column) -> Column:
        groups = F.regexp_extract_all(acc["text"], F.lit(_GROUP), F.lit(0))
        lifted = F.filter(
            F.transform(
                groups,
                lambda g, i: F.struct(
                    level.alias("level"), (acc["n"] + i).alias("id"), inside(g).alias("text")
                ),
            ),
            lambda s: s["text"].rlike(_SCOPE_WORD),
        )

        def render(group: Column, i: Column) -> Column:
            reference = F.concat(
                F.lit(" " + REF_OPEN), (acc["n"] + i).cast("string"), F.lit(REF_CLOSE + " ")
            )
            return F.when(inside(group).rlike(_SCOPE_WORD), reference).otherwise(
                _ordinary(inside(group))
            )

        return F.struct(
            _splice(acc["text"], _GROUP, render).alias("text"),
            F.concat(acc["scopes"], lifted).alias("scopes"),
            (acc["n"] + F.size(groups)).alias("n"),
        )

    levels = F.when(depth > 0, F.sequence(F.lit(1), depth)).otherwise(
        F.array().cast("array<int>")
    )
    return F.aggregate(
        levels,
        start,
        step,
        lambda acc: F.struct(
            acc["text"].alias("text"), acc["scopes"].alias("scopes")
        ),
    )


def branches(scope_text: Column) -> Column:
    """The SELECTs of a scope, cut at set operators."""
    return F.when(
        _mentions(scope_text, "union", "intersect", "except", "minus"),
        cut(scope_text, _SET_OPERATOR),
    ).otherwise(F.array(scope_text))


def from_body(branch: Column) -> Column:
    """Text from the first FROM up to the clause that follows the sources.

    A bracketed join has no SELECT: all of it is body.
    """
    whole = F.when(
        branch.rlike(r"(?i)\bselect\b"), F.regexp_extract(branch, _SELECT_FROM, 1)
    ).otherwise(F.when(branch.rlike(r"(?i)\bjoin\b"), branch).otherwise(""))
    return F.get(cut(whole, _BODY_END), F.lit(0))


def _item(word: Column, text: Column) -> Column:
    head = F.regexp_replace(
        F.trim(F.regexp_extract(text, _TABLE, 0)), r"(?i)^(?:lateral|only) ", ""
    )

    def named(tokens: Column) -> Column:
        alias = F.when(F.size(tokens) > 1, decode(F.element_at(tokens, -1)))

        def placed(parts: Column) -> Column:
            return F.struct(
                word.alias("word"),
                text.alias("text"),
                F.nullif(alias, F.lit("")).alias("alias"),
                F.nullif(decode(F.try_element_at(parts, F.lit(-2))), F.lit("")).alias("schema"),
                decode(F.element_at(parts, -1)).alias("table"),
            )

        return let(F.split(F.element_at(tokens, 1), r"\."), placed)

    return let(F.split(head, " "), named)


def items(body: Column) -> Column:
    """Sources in order: ``struct(word, text, alias, schema, table)``.

    ``word`` is the comma or join keyword in front; ``table`` is '' for anything but
    a plain table.
    """
    marked = F.regexp_replace(body, _CUT, f"{CUT}$0{WORD_END}")
    return F.transform(
        F.split(marked, CUT),
        lambda piece: _item(
            F.when(F.contains(piece, F.lit(WORD_END)), F.substring_index(piece, WORD_END, 1))
            .otherwise(""),
            F.substring_index(piece, WORD_END, -1),
        ),
    )


def plain_sources(items_: Column) -> Column:
    """The plain tables among the items: ``struct(alias, schema, table)``."""
    return F.transform(
        F.filter(items_, lambda i: i["table"] != ""),
        lambda i: F.struct(
            i["alias"].alias("alias"), i["schema"].alias("schema"), i["table"].alias("table")
        ),
    )


def references(text: Column) -> Column:
    """Ids of the lifted scopes mentioned in ``text``."""
    return F.transform(
        F.regexp_extract_all(text, F.lit(f"{REF_OPEN}([0-9]+){REF_CLOSE}"), F.lit(1)),
        lambda i: i.cast("int"),
    )


def names(sources: Column) -> Column:
    """Lookup list ``struct(key, schema, table)``: alias, then bare name, in order."""

    def keys(s: Column) -> Column:
        def entry(key: Column) -> Column:
            return F.struct(
                F.lower(key).alias("key"), s["schema"].alias("schema"), s["table"].alias("table")
            )

        return F.filter(
            F.array(entry(s["alias"]), entry(s["table"])), lambda e: e["key"].isNotNull()
        )

    return F.flatten(F.transform(sources, keys))


def join_kind(word: Column) -> Column:
    """Side if given, else kind, else JOIN."""
    upper = F.upper(word)
    kind = F.lit("JOIN")
    for known in ("ANTI", "SEMI", "OUTER", "CROSS", "INNER", "FULL", "RIGHT", "LEFT"):
        kind = F.when(F.contains(upper, F.lit(known)), known).otherwise(kind)
    return kind


def conditions(items_: Column) -> Column:
    """Depth-marked condition of each item, '' where it has none.

    Joins wait on a stack until an ON closes the innermost of them, so ``a JOIN b JOIN c ON x ON y`` gives
    c the condition x and b the condition y.  A comma empties the stack.
    """
    one = F.transform(items_, lambda i: F.trim(F.regexp_extract(i["text"], r"(?i)\bon\b(.*)$", 1)))
    start = F.struct(
        F.array().cast("array<int>").alias("open"),
        F.lit(0).alias("at"),
        F.array().cast("array<struct<at:int,on:string>>").alias("closed"),
    )

    def step(acc: Column, item: Column) -> Column:
        word = F.lower(item["word"])
        waits = F.endswith(word, F.lit("join")) & ~word.rlike(r"\b(?:cross|natural)\b") & ~item["text"].rlike(r"(?i)\busing\b")
        kept = F.when(F.contains(word, F.lit("join")), acc["open"]).otherwise(F.array().cast("array<int>"))
        texts = F.split(item["text"], r"(?i)\bon\b")

        def closing(open_: Column) -> Column:
            n = F.least(F.size(open_), F.size(texts) - 1)
            own = F.transform(
                F.slice(texts, F.lit(2), n),
                lambda on, k: F.struct(F.get(open_, F.size(open_) - 1 - k).alias("at"), F.trim(on).alias("on")),
            )
            return F.struct(
                F.slice(open_, F.lit(1), F.size(open_) - n).alias("open"),
                (acc["at"] + 1).alias("at"),
                F.concat(acc["closed"], own).alias("closed"),
            )

        return let(F.when(waits, F.concat(kept, F.array(acc["at"]))).otherwise(kept), closing)

    def placed(closed: Column) -> Column:
        return F.transform(
            items_, lambda _, i: F.coalesce(F.get(F.filter(closed, lambda c: c["at"] == i), F.lit(0))["on"], F.lit(""))
        )

    folded = let(F.aggregate(items_, start, step, lambda acc: acc["closed"]), placed)
    several = F.exists(items_, lambda i: i["text"].rlike(r"(?i)\bon\b.*\bon\b"))
    return F.transform(F.when(several, folded).otherwise(one), lambda on: mark_depth(on, 0))


def equalities(condition: Column) -> Column:
    """``struct(left, right)`` column names of each ``column = column``, shallowest first."""
    found = F.regexp_extract_all(condition, F.lit(_EQUALITY), F.lit(0))

    def ranked(match: Column, i: Column) -> Column:
        bare = F.replace(match, F.lit(DEPTH), F.lit(""))
        left = F.element_at(F.split(F.trim(F.substring_index(bare, "=", 1)), " "), -1)
        return F.struct(
            (F.length(match) - F.length(bare)).alias("depth"),
            i.alias("at"),
            F.translate(left, OPEN + COMMA, "").alias("left"),
            F.trim(F.substring_index(bare, "=", -1)).alias("right"),
        )

    return F.array_sort(F.transform(found, ranked))


def resolve(name: Column, lookup: Column) -> Column:
    """``struct(schema, table, column)``; the qualifier is looked up without regard to case."""

    def found(parts: Column) -> Column:
        qualifier = decode(F.try_element_at(parts, F.lit(-2)))

        def placed(hit: Column) -> Column:
            return F.struct(
                hit["schema"].alias("schema"),
                F.when(hit.isNotNull(), hit["table"]).otherwise(qualifier).alias("table"),
                decode(F.element_at(parts, -1)).alias("column"),
            )

        return let(qualifier, lambda q: let(
            F.get(F.filter(lookup, lambda e: e["key"] == F.lower(q)), F.lit(0)), placed
        ))

    return let(F.split(name, r"\."), found)
