import json
import random
import time

from tessera.functions.text import slug, xml_attr
from tessera.operators import changes, documents, rendering
from tessera.plans import scan_plans
from tessera.sources import projects

FULL = {
    "schema_version": 1,
    "extra": "ignored",
    "project": {
        "name": "Shop",
        "modeling_paradigm": "star",
        "dialect": "trino",
        "description": "A & B",
        "tags": ["x", "y"],
        "conventions": "dates are UTC",
        "glossary": [{"term": 'active "customer"', "definition": "bought < 90 days"}],
        "measures": [{"name": "MAC", "definition": "monthly", "formula": "count(*)", "owner": "bi"}],
    },
    "connections": [{"name": "lake", "engine": "trino", "dsn": "d", "catalog": "hive"}],
    "tables": [
        {"table_name": "loose", "upstream": [{"ref": "fct"}, {"ref": "raw.x", "description": "why"}]},
        {
            "table_name": "fct",
            "connection": "lake",
            "paradigm_role": "fact",
            "grain": "one row per order",
            "aliases": ["transactions"],
            "pitfalls": ["no test rows"],
            "owner": "data",
            "refresh_cadence": "hourly",
            "refresh_notes": "late on Mondays",
            "scd": {"type": "scd2", "valid_from": "f", "valid_to": "t", "is_current_flag": "c"},
            "row_count_last_run": 1234567,
            "last_run_at": "2024-01-01T00:00:00Z",
            "primary_keys": ["id"],
            "staging_target": "s.fct",
            "columns": [
                {"name": "id", "type": "bigint", "nullable": False, "is_primary_key": True},
                {"name": "mail", "type": "text", "classification": "pii", "quality_notes": "30% null",
                 "example_values": ["a", "b"]},
                {"name": "net", "computed": True, "expression": "a - b"},
            ],
            "relationships": [
                {"to_table": "dim", "from_columns": ["a", "b"], "to_columns": ["a", "b"],
                 "cardinality": "many_to_many", "description": "rare"}
            ],
        },
    ],
}


def read(spark, folder, **files):
    for name, doc in files.items():
        text = doc if isinstance(doc, str) else json.dumps(doc)
        (folder / f"{name}.json").write_text(text, encoding="utf-8")
    return projects.read_projects(spark, str(folder))


def test_listing_survives_broken_files(spark, tmp_path):
    (tmp_path / "notes.txt").write_text("{}")
    docs = read(spark, tmp_path, b=FULL, a="{bad", c="[1, 2]", d={"project": {}}, e={"tables": []})
    got = [tuple(r) for r in projects.list_projects(docs).collect()]
    assert got == [
        ("a.json", "<unparseable>", ""),
        ("b.json", "Shop", ""),
        ("c.json", "<unparseable>", ""),
        ("d.json", "<unparseable>", ""),
        ("e.json", "<unparseable>", ""),
    ]
    assert json.loads(projects.raw_documents(docs).where("project_id = 'b.json'").first().content) == FULL


def test_flatten_find_and_validate(spark, tmp_path):
    docs = read(spark, tmp_path, b=FULL)
    flat = documents.flatten(docs)
    assert {k: df.count() for k, df in flat.items()} == {
        "projects": 1, "connections": 1, "tables": 2, "columns": 3, "relationships": 1, "upstream": 2,
        "glossary": 1, "measures": 1,
    }
    row = documents.find(flat["tables"], "table_name", "loose").first()
    assert (row.refresh_cadence, row.ddl_only, row.description, row.pos) == ("unknown", False, "", 0)
    col = flat["columns"].where("name = 'net'").first()
    assert (col.type, col.nullable, col.classification) == ("", True, "unspecified")
    (edge,) = documents.downstream(flat["upstream"], flat["tables"]).where("ref = 'fct'").collect()
    assert edge.table_name == "loose"
    assert changes.validate(flat).count() == 0


def test_violations(spark, tmp_path):
    bad = json.loads(json.dumps(FULL))
    bad["schema_version"] = 2
    bad["project"]["name"] = ""
    bad["connections"][0] |= {"engine": "db2", "name": "n" * 61}
    bad["tables"][0] |= {"grain": "g" * 241, "pitfalls": ["ok", "p" * 241], "scd": {"type": "scd9"}}
    bad["tables"][1]["columns"][0]["classification"] = "secret"
    bad["tables"][1]["relationships"][0]["cardinality"] = None
    got = {
        (r.path, r.rule, r.severity)
        for r in changes.validate(documents.flatten(read(spark, tmp_path, b=bad))).collect()
    }
    assert got == {
        ("projects/schema_version", "supported version", "documented"),
        ("projects/name", "required, not empty", "enforced"),
        ("connections/0/engine", "allowed word", "enforced"),
        ("connections/0/name", "at most 60 characters", "documented"),
        ("tables/0/grain", "at most 240 characters", "enforced"),
        ("tables/0/pitfalls/1", "at most 240 characters", "documented"),
        ("tables/0/scd_type", "allowed word", "enforced"),
        ("columns/fct/0/classification", "allowed word", "enforced"),
        ("relationships/fct/0/cardinality", "required", "enforced"),
    }


def test_xml(spark, tmp_path):
    text = rendering.render_xml(read(spark, tmp_path, b=FULL), "model", "about").first().text
    for part in (
        'about\n\n<model name="Shop" dialect="trino" paradigm="star">\n  <description>A &amp; B</description>',
        "  <tags>x, y</tags>\n  <conventions>dates are UTC</conventions>",
        '    <term name="active "customer"">bought &lt; 90 days</term>',
        '    <measure name="MAC" owner="bi">\n      <definition>monthly</definition>\n      <formula>count(*)</formula>',
        '  <connection name="lake" engine="trino" catalog="hive">\n    <dsn>d</dsn>\n  </connection>\n  <table name="fct"',
        ' paradigm_role="fact" owner="data" refresh_cadence="hourly" row_count_last_run="1234567"'
        ' last_run_at="2024-01-01T00:00:00Z">',
        '    <scd type="scd2" valid_from="f" valid_to="t" is_current_flag="c"/>',
        '      <column name="fct.id" raw_name="id" type="bigint" pk="true" not_null="true"/>',
        '      <column name="fct.net" raw_name="net" computed="true">\n        <expression>a - b</expression>',
        '<relationship from="fct.a, fct.b" to="dim.a, dim.b" cardinality="many_to_many">'
        "fct and dim are joined many-to-many. rare</relationship>",
        "    <downstream>loose</downstream>\n  </table>\n  <table name=\"loose\">\n    <upstream>",
        '<depends_on ref="fct">loose reads from fct.</depends_on>',
        '<depends_on ref="raw.x">why</depends_on>',
    ):
        assert part in text, part
    assert text.endswith("</model>\n") and "staging_target" not in text


def test_defaults_leave_no_trace(spark, tmp_path):
    bare = {"project": {"name": "Bare"}, "tables": [{"table_name": "t", "columns": [{"name": "c"}]}]}
    docs = read(spark, tmp_path, b=bare)
    assert rendering.render_xml(docs).first().text == (
        '<project name="Bare" dialect="tsql">\n  <table name="t">\n    <columns>\n'
        '      <column name="t.c" raw_name="c"/>\n    </columns>\n  </table>\n</project>\n'
    )
    assert rendering.render_markdown(docs).first().text == (
        "# Bare\n\n- Dialect: `tsql`\n\n## Connections (0)\n\n## Tables (1)\n\n### t\n\nColumns:\n- `c` \n"
    )


def test_markdown(spark, tmp_path):
    text = rendering.render_markdown(read(spark, tmp_path, b=FULL)).first().text
    for part in (
        "# Shop\n\nA & B\n\n- Dialect: `trino`\n- Paradigm: `star`\n- Tags: x, y\n\n## Conventions\ndates are UTC",
        '## Glossary (1)\n- **active "customer"** — bought < 90 days',
        "- **MAC** — monthly\n    - Formula: `count(*)`\n    - Owner: bi",
        "- **lake** — trino, dsn=`d`, catalog=`hive`",
        "### fct\n- Connection: `lake`\n- Target: `s.fct`\n- Grain: one row per order\n- Aliases: transactions",
        "- Refresh: `hourly` — late on Mondays\n- Row count: 1,234,567 @ 2024-01-01T00:00:00Z",
        "- SCD: type=scd2, valid_from=f, valid_to=t, is_current=c",
        "- `id` bigint  _(PK, NOT NULL)_\n- `mail` text  _(PII)_\n    - Quality: 30% null\n    - Examples: a, b",
        "- fct.a,b → dim.a,b (many_to_many) — rare",
        "Upstream:\n- `fct`\n- `raw.x` — why",
        "Downstream: loose",
    ):
        assert part in text, part
    assert text.index("### loose") < text.index("### fct")


def test_slugs(spark):
    cases = {
        "Customer Warehouse": "customer_warehouse", "  Spaces   And  Stuff!! ": "spaces_and_stuff",
        "PII / 2024": "pii_2024", "___": "untitled", "": "untitled",
    }
    df = spark.createDataFrame(list(cases.items()), "name string, expected string")
    assert df.where(slug(df.name) != df.expected).count() == 0


def test_attribute_quoting(spark):
    from xml.sax.saxutils import quoteattr

    values = ["a\"b", "a'b", "a\"'b", "a\n\t\r<&>"]
    df = spark.createDataFrame([(v, quoteattr(v)[1:-1]) for v in values], "v string, expected string")
    assert df.where(xml_attr(df.v) != df.expected).count() == 0


def plain_order(connections, tables):
    """Names of rendered tables with their readers, by plain loops."""
    owned = [t for c in connections for t in tables if t.get("connection") == c["name"]]
    names = {t["table_name"] for t in owned}
    return [
        (t["table_name"], ", ".join(r["table_name"] for r in tables for d in r["upstream"] if d["ref"] == t["table_name"]))
        for t in owned + [t for t in tables if t["table_name"] not in names]
    ]


def made_tables(rng, n, names, connections):
    return [
        {
            "table_name": f"t{rng.randrange(names)}",
            "upstream": [{"ref": f"t{rng.randrange(names + 3)}"} for _ in range(rng.randrange(4))],
            **({"connection": f"c{rng.randrange(connections + 2)}"} if rng.random() < 0.8 else {}),
        }
        for _ in range(n)
    ]


def test_order_and_readers_equal_plain_loops(spark, tmp_path):
    """Repeated names of tables and connections, references to nothing, connections of nobody."""
    rng = random.Random(3)
    given = {}
    for k in range(12):
        connections = [{"name": f"c{rng.randrange(4)}", "engine": "e", "dsn": "d"} for _ in range(k % 5)]
        given[f"d{k}"] = {
            "schema_version": 1, "project": {"name": "p"}, "connections": connections,
            "tables": made_tables(rng, 3 * k, 2 * k + 1, 4),
        }
    texts = rendering.render_xml(read(spark, tmp_path, **given)).collect()
    assert len(texts) == len(given)
    for row in texts:
        doc = next(d for name, d in given.items() if name in row.project_id.split("/")[-1].split("."))
        shown = []
        for line in row.text.split("\n"):
            if line.startswith("  <table "):
                shown.append((line.split('"')[1], ""))
            elif line.startswith("    <downstream>"):
                shown[-1] = (shown[-1][0], line.strip()[len("<downstream>") : -len("</downstream>")])
        assert shown == plain_order(doc["connections"], doc["tables"])


def test_rendering_time_grows_with_the_tables(spark, tmp_path):
    seconds = {}
    for n in (1_000, 10_000):
        connections = [{"name": f"c{k}", "engine": "e", "dsn": "d"} for k in range(n // 10)]
        tables = made_tables(random.Random(n), n, n, n // 10)
        doc = {"schema_version": 1, "project": {"name": "p"}, "connections": connections, "tables": tables}
        folder = tmp_path / str(n)
        folder.mkdir()
        docs = read(spark, folder, b=doc).cache()
        docs.count()
        rendering.render_xml(docs).collect()
        start = time.monotonic()
        rendering.render_xml(docs).collect()
        seconds[n] = time.monotonic() - start
    print(seconds)
    assert seconds[10_000] < 25 * max(seconds[1_000], 0.2)


def test_project_files_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(scan_plans, "working_folder", lambda _, name: str(tmp_path / name))
    assert scan_plans.scanned_projects(spark, "/root/testdata/sf0.01").count() == 100
    files = list((tmp_path / "projects").glob("part-*.txt"))
    assert len(files) == 100 and len({f.name[:10] for f in files}) > 1
