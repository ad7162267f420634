"""Project documents as XML or markdown text.

A document arrives as one nested row and leaves as one text: higher-order
functions walk the nested lists, so rendering a million projects is one
projection over the scan, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.arrays import runs
from tessera.functions.sqltext import let
from tessera.functions.text import lines, nonempty, xml_attr, xml_text


def _list(values: Column) -> Column:
    """Comma-separated list, null when empty."""
    return nonempty(F.array_join(values, ", "))


def _unless(value: Column, default: str) -> Column:
    return F.when(value != default, nonempty(value))


def _flag(value: Column) -> Column:
    return F.when(value, F.lit("true"))


def _attrs(*pairs: tuple[str, Column]) -> Column:
    """``a="1" b="2"``; absent and empty values are left out."""
    return F.concat_ws(
        " ", *[F.concat(F.lit(f'{k}="'), xml_attr(nonempty(v)), F.lit('"')) for k, v in pairs]
    )


def _element(indent: int, tag: str, value: Column) -> Column:
    return F.concat(
        F.lit(" " * indent + f"<{tag}>"), xml_text(nonempty(value)), F.lit(f"</{tag}>")
    )


def _each(items: Column, render: Callable[[Column], Column]) -> Column:
    """Rendered items on lines of their own, null when there are none."""
    return nonempty(F.array_join(F.transform(items, render), "\n"))


def _section(indent: int, tag: str, body: Column) -> Column:
    pad = " " * indent
    return F.concat(F.lit(f"{pad}<{tag}>\n"), body, F.lit(f"\n{pad}</{tag}>"))


def relationship_sentence(
    from_table: Column, to_table: Column, cardinality: Column, description: Column
) -> Column:
    """The edge in words."""
    say = F.concat
    phrase = (
        F.when(
            cardinality == "one_to_one",
            say(F.lit("Each "), from_table, F.lit(" maps to exactly one "), to_table,
                F.lit(", and vice versa.")),
        )
        .when(
            cardinality == "one_to_many",
            say(F.lit("Each "), from_table, F.lit(" relates to one "), to_table, F.lit("; a "),
                to_table, F.lit(" has many "), from_table, F.lit(".")),
        )
        .when(
            cardinality == "many_to_many",
            say(from_table, F.lit(" and "), to_table, F.lit(" are joined many-to-many.")),
        )
        .otherwise(
            say(from_table, F.lit(" relates to "), to_table, F.lit(" ("), cardinality, F.lit(")."))
        )
    )
    return F.concat_ws(" ", phrase, nonempty(description))


def _named(items: Column, kind: int, name: Callable[[Column], Column]) -> Column:
    """``(name, kind, at)`` of the items, to be sorted among those of another kind."""
    return F.transform(
        items, lambda x, i: F.struct(name(x).alias("name"), F.lit(kind).alias("kind"), i.alias("at"))
    )


def _matched(left: Column, right: Column, emit: Callable[[Column, Column], Column]) -> Column:
    """``emit(positions left, positions right)`` for each name, null names left out."""

    def positions(run: Column, kind: int) -> Column:
        return F.filter(run, lambda e: e["kind"] == kind)["at"]

    groups = runs(F.sort_array(F.concat(left, right)), lambda e: e["name"])
    named = F.filter(groups, lambda run: F.get(run, F.lit(0))["name"].isNotNull())
    return F.flatten(F.transform(named, lambda run: emit(positions(run, 0), positions(run, 1))))


def with_downstream(tables: Column) -> Column:
    """``struct(table, downstream)``: each table and the names of those that read it, in table order.

    Names of tables and references to them are sorted together once; nothing is searched.
    """

    def readers(own: Column) -> Column:
        return F.flatten(
            F.transform(
                own,
                lambda t: F.transform(
                    F.coalesce(t["upstream"], F.array()),
                    lambda d: F.struct(d["ref"].alias("ref"), t["table_name"].alias("table_name")),
                ),
            )
        )

    def found(own: Column, read: Column) -> Column:
        def emit(at: Column, by: Column) -> Column:
            names = F.transform(by, lambda i: F.get(read, i)["table_name"])
            return let(names, lambda n: F.transform(at, lambda i: F.struct(i.alias("at"), n.alias("names"))))

        listed = _matched(
            _named(own, 0, lambda t: t["table_name"]), _named(read, 1, lambda r: r["ref"]), emit
        )
        # tables without a name are in no list, but keep their place
        unnamed = F.filter(
            F.transform(
                own,
                lambda t, i: F.when(
                    t["table_name"].isNull(), F.struct(i.alias("at"), F.array().cast("array<string>").alias("names"))
                ),
            ),
            lambda e: e.isNotNull(),
        )
        ordered = F.sort_array(F.concat(listed, unnamed))
        return F.zip_with(
            own, ordered, lambda t, e: F.struct(t.alias("table"), e["names"].alias("downstream"))
        )

    return let(tables, lambda own: let(readers(own), lambda read: found(own, read)))


def in_render_order(connections: Column, tables: Column) -> Column:
    """Items of ``with_downstream`` by connection in connection order, the others behind them.

    A table without a name, or with the name of one that a connection owns, is not among the others.
    """

    def both(at: Column, by: Column) -> Column:
        return let(
            by,
            lambda own: F.flatten(
                F.transform(
                    at, lambda c: F.transform(own, lambda t: F.struct(c.alias("connection"), t.alias("at")))
                )
            ),
        )

    def ordered(items: Column) -> Column:
        def behind(owned: Column) -> Column:
            known = F.transform(owned, lambda i: F.get(items, i))
            rest = _matched(
                _named(known, 0, lambda x: x["table"]["table_name"]),
                _named(items, 1, lambda x: x["table"]["table_name"]),
                lambda at, by: F.filter(by, lambda _: F.size(at) == 0),
            )
            return F.transform(F.concat(owned, F.sort_array(rest)), lambda i: F.get(items, i))

        pairs = _matched(
            _named(connections, 0, lambda c: c["name"]),
            _named(items, 1, lambda x: x["table"]["connection"]),
            both,
        )
        return let(F.sort_array(pairs)["at"], behind)

    return let(tables, ordered)


def _xml_column(table: Column, col: Column) -> Column:
    head = _attrs(
        ("name", F.concat(table["table_name"], F.lit("."), col["name"])),
        ("raw_name", col["name"]),
        ("type", col["type"]),
        ("pk", _flag(col["is_primary_key"])),
        ("fk", _flag(col["is_foreign_key"])),
        ("not_null", _flag(~col["nullable"])),
        ("classification", _unless(col["classification"], "unspecified")),
        ("computed", _flag(col["computed"])),
    )
    children = lines(
        _element(8, "description", col["description"]),
        _element(8, "quality_notes", col["quality_notes"]),
        _element(8, "expression", col["expression"]),
        _element(8, "example_values", _list(col["example_values"])),
    )
    opening = F.concat(F.lit("      <column "), head)
    return F.when(children == "", F.concat(opening, F.lit("/>"))).otherwise(
        F.concat(opening, F.lit(">\n"), children, F.lit("\n      </column>"))
    )


def _xml_relationship(table: Column, rel: Column) -> Column:
    def qualified(name: Column, cols: Column) -> Column:
        return F.array_join(F.transform(cols, lambda c: F.concat(name, F.lit("."), c)), ", ")

    head = _attrs(
        ("from", qualified(table["table_name"], rel["from_columns"])),
        ("to", qualified(rel["to_table"], rel["to_columns"])),
        ("cardinality", rel["cardinality"]),
    )
    sentence = relationship_sentence(
        table["table_name"], rel["to_table"], rel["cardinality"], rel["description"]
    )
    return F.concat(
        F.lit("      <relationship "), head, F.lit(">"), xml_text(sentence), F.lit("</relationship>")
    )


def _xml_upstream(table: Column, dep: Column) -> Column:
    plain = F.concat(table["table_name"], F.lit(" reads from "), dep["ref"], F.lit("."))
    return F.concat(
        F.lit("      <depends_on "),
        _attrs(("ref", dep["ref"])),
        F.lit(">"),
        F.coalesce(xml_text(nonempty(dep["description"])), plain),
        F.lit("</depends_on>"),
    )


def _xml_table(table: Column, downstream: Column) -> Column:
    scd = table["scd"]
    head = _attrs(
        ("name", table["table_name"]),
        ("connection", table["connection"]),
        ("source_file", table["source_file"]),
        ("ddl_only", _flag(table["ddl_only"])),
        ("db_kind", table["db_kind"]),
        ("paradigm_role", table["paradigm_role"]),
        ("owner", table["owner"]),
        ("refresh_cadence", _unless(table["refresh_cadence"], "unknown")),
        ("row_count_last_run", table["row_count_last_run"].cast("string")),
        ("last_run_at", table["last_run_at"]),
    )
    scd_line = F.when(
        scd["type"] != "none",
        F.concat(
            F.lit("    <scd "),
            _attrs(
                ("type", scd["type"]),
                ("valid_from", scd["valid_from"]),
                ("valid_to", scd["valid_to"]),
                ("is_current_flag", scd["is_current_flag"]),
            ),
            F.lit("/>"),
        ),
    )
    return lines(
        F.concat(F.lit("  <table "), head, F.lit(">")),
        _element(4, "description", table["description"]),
        _element(4, "grain", table["grain"]),
        _element(4, "aliases", _list(table["aliases"])),
        _element(4, "tags", _list(table["tags"])),
        _section(4, "pitfalls", _each(table["pitfalls"], lambda p: _element(6, "pitfall", p))),
        scd_line,
        _element(4, "refresh_notes", table["refresh_notes"]),
        _element(4, "primary_key", _list(table["primary_keys"])),
        _section(4, "columns", _each(table["columns"], lambda c: _xml_column(table, c))),
        _section(
            4, "relationships", _each(table["relationships"], lambda r: _xml_relationship(table, r))
        ),
        _section(4, "upstream", _each(table["upstream"], lambda d: _xml_upstream(table, d))),
        _element(4, "downstream", _list(downstream)),
        F.lit("  </table>"),
    )


def _xml_connection(c: Column) -> Column:
    head = _attrs(
        ("name", c["name"]),
        ("engine", c["engine"]),
        ("catalog", c["catalog"]),
        ("default_schema", c["default_schema"]),
    )
    return lines(
        F.concat(F.lit("  <connection "), head, F.lit(">")),
        F.concat(
            F.lit("    <dsn>"), xml_text(F.coalesce(c["dsn"], F.lit(""))), F.lit("</dsn>")
        ),
        _element(4, "description", c["description"]),
        _element(4, "tags", _list(c["tags"])),
        F.lit("  </connection>"),
    )


def _xml_measure(m: Column) -> Column:
    return lines(
        F.concat(
            F.lit("    <measure "), _attrs(("name", m["name"]), ("owner", m["owner"])), F.lit(">")
        ),
        _element(6, "definition", m["definition"]),
        _element(6, "formula", m["formula"]),
        F.lit("    </measure>"),
    )


def _xml_term(g: Column) -> Column:
    return F.concat(
        F.lit('    <term name="'),
        xml_attr(g["term"]),
        F.lit('">'),
        xml_text(g["definition"]),
        F.lit("</term>"),
    )


def _lists(documents: DataFrame) -> tuple[Column, Column, Column]:
    doc = F.col("doc")
    return (
        doc["project"],
        F.coalesce(doc["connections"], F.array()),
        F.coalesce(doc["tables"], F.array()),
    )


def render_xml(documents: DataFrame, root: str = "project", preamble: str | None = None) -> DataFrame:
    """``(project_id, doc)`` -> ``(project_id, text)``.

    ``root`` names the outer element; ``preamble`` is put in front, followed by an
    empty line.
    """
    cfg, connections, tables = _lists(documents)
    prepared = documents.select(
        "project_id",
        cfg.alias("_cfg"),
        connections.alias("_connections"),
        in_render_order(connections, with_downstream(tables)).alias("_tables"),
    )
    cfg = F.col("_cfg")
    head = _attrs(
        ("name", cfg["name"]),
        ("dialect", F.coalesce(cfg["dialect"], F.lit("tsql"))),
        ("default_connection", cfg["default_connection"]),
        ("paradigm", _unless(cfg["modeling_paradigm"], "unspecified")),
    )
    text = lines(
        *([F.lit(preamble), F.lit("")] if preamble is not None else []),
        F.concat(F.lit(f"<{root} "), head, F.lit(">")),
        _element(2, "description", cfg["description"]),
        _element(2, "tags", _list(cfg["tags"])),
        _element(2, "conventions", cfg["conventions"]),
        _section(2, "glossary", _each(cfg["glossary"], _xml_term)),
        _section(2, "measures", _each(cfg["measures"], _xml_measure)),
        _each(F.col("_connections"), _xml_connection),
        _each(F.col("_tables"), lambda t: _xml_table(t["table"], t["downstream"])),
        F.lit(f"</{root}>"),
        F.lit(""),
    )
    return prepared.select("project_id", text.alias("text"))


def _after(prefix: str, value: Column, suffix: str = "") -> Column:
    """``prefix`` + value + ``suffix``, null when the value is absent or empty."""
    return F.concat(F.lit(prefix), nonempty(value), F.lit(suffix))


def _or_nothing(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def _titled(title: Column, body: Column) -> Column:
    """Empty line, title, body; null without a body."""
    return F.concat(F.lit("\n"), title, F.lit("\n"), body)


def _md_column(col: Column) -> Column:
    flags = F.concat_ws(
        ", ",
        F.when(col["is_primary_key"], "PK"),
        F.when(col["is_foreign_key"], "FK"),
        F.when(~col["nullable"], "NOT NULL"),
        F.upper(_unless(col["classification"], "unspecified")),
        F.when(col["computed"], "computed"),
    )
    line = F.concat(
        F.lit("- `"),
        col["name"],
        F.lit("` "),
        _or_nothing(col["type"]),
        _or_nothing(_after("  _(", flags, ")_")),
        _or_nothing(_after(" — ", col["description"])),
    )
    return lines(
        line,
        _after("    - Quality: ", col["quality_notes"]),
        _after("    - Expression: `", col["expression"], "`"),
        _after("    - Examples: ", _list(col["example_values"])),
    )


def _md_relationship(table: Column, rel: Column) -> Column:
    return F.concat(
        F.lit("- "),
        table["table_name"],
        F.lit("."),
        F.array_join(rel["from_columns"], ","),
        F.lit(" → "),
        rel["to_table"],
        F.lit("."),
        F.array_join(rel["to_columns"], ","),
        F.lit(" ("),
        rel["cardinality"],
        F.lit(")"),
        _or_nothing(_after(" — ", rel["description"])),
    )


def _md_table(table: Column, downstream: Column) -> Column:
    scd = table["scd"]
    refresh = F.concat(
        _after("- Refresh: `", _unless(table["refresh_cadence"], "unknown"), "`"),
        _or_nothing(_after(" — ", table["refresh_notes"])),
    )
    rows = F.concat(
        F.lit("- Row count: "),
        F.format_number(table["row_count_last_run"], 0),
        _or_nothing(_after(" @ ", table["last_run_at"])),
    )
    history = F.when(
        scd["type"] != "none",
        F.concat(
            F.lit("- SCD: "),
            F.concat_ws(
                ", ",
                _after("type=", scd["type"]),
                _after("valid_from=", scd["valid_from"]),
                _after("valid_to=", scd["valid_to"]),
                _after("is_current=", scd["is_current_flag"]),
            ),
        ),
    )
    return lines(
        F.concat(F.lit("\n### "), table["table_name"]),
        _after("- Connection: `", table["connection"], "`"),
        _after("- Target: `", table["staging_target"], "`"),
        _after("- Grain: ", table["grain"]),
        _after("- Aliases: ", _list(table["aliases"])),
        _after("- Owner: ", table["owner"]),
        refresh,
        rows,
        history,
        _after("\n", table["description"]),
        _titled(F.lit("Pitfalls:"), _each(table["pitfalls"], lambda p: F.concat(F.lit("- "), p))),
        _after("\nPK: `", _list(table["primary_keys"]), "`"),
        _titled(F.lit("Columns:"), _each(table["columns"], _md_column)),
        _titled(
            F.lit("Relationships:"),
            _each(table["relationships"], lambda r: _md_relationship(table, r)),
        ),
        _titled(
            F.lit("Upstream:"),
            _each(
                table["upstream"],
                lambda d: F.concat(
                    F.lit("- `"),
                    d["ref"],
                    F.lit("`"),
                    _or_nothing(_after(" — ", d["description"])),
                ),
            ),
        ),
        _after("\nDownstream: ", _list(downstream)),
    )


def _md_measure(m: Column) -> Column:
    return lines(
        F.concat(F.lit("- **"), m["name"], F.lit("** — "), m["definition"]),
        _after("    - Formula: `", m["formula"], "`"),
        _after("    - Owner: ", m["owner"]),
    )


def _md_connection(c: Column) -> Column:
    return lines(
        F.concat(
            F.lit("- **"),
            c["name"],
            F.lit("** — "),
            c["engine"],
            F.lit(", dsn=`"),
            c["dsn"],
            F.lit("`"),
            _or_nothing(_after(", catalog=`", c["catalog"], "`")),
        ),
        _after("  - ", c["description"]),
    )


def _counted(title: str, items: Column) -> Column:
    return F.concat(F.lit(f"## {title} ("), F.size(items).cast("string"), F.lit(")"))


def render_markdown(documents: DataFrame) -> DataFrame:
    """``(project_id, doc)`` -> ``(project_id, text)``, tables in document order."""
    cfg, connections, tables = _lists(documents)
    prepared = documents.select(
        "project_id",
        cfg.alias("_cfg"),
        connections.alias("_connections"),
        with_downstream(tables).alias("_tables"),
    )
    cfg, connections, tables = (F.col(c) for c in ("_cfg", "_connections", "_tables"))
    text = lines(
        F.concat(F.lit("# "), cfg["name"]),
        _after("\n", cfg["description"]),
        F.concat(F.lit("\n- Dialect: `"), F.coalesce(cfg["dialect"], F.lit("tsql")), F.lit("`")),
        _after("- Paradigm: `", _unless(cfg["modeling_paradigm"], "unspecified"), "`"),
        _after("- Default connection: `", cfg["default_connection"], "`"),
        _after("- Tags: ", _list(cfg["tags"])),
        _titled(F.lit("## Conventions"), nonempty(cfg["conventions"])),
        _titled(
            _counted("Glossary", cfg["glossary"]),
            _each(
                cfg["glossary"],
                lambda g: F.concat(F.lit("- **"), g["term"], F.lit("** — "), g["definition"]),
            ),
        ),
        _titled(_counted("Measures", cfg["measures"]), _each(cfg["measures"], _md_measure)),
        F.concat(F.lit("\n"), _counted("Connections", connections)),
        _each(connections, _md_connection),
        F.concat(F.lit("\n"), _counted("Tables", tables)),
        _each(tables, lambda t: _md_table(t["table"], t["downstream"])),
        F.lit(""),
    )
    return prepared.select("project_id", text.alias("text"))
