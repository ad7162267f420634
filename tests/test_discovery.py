import pytest

from tessera.operators import discovery
from tessera.sources import corpus


def _end(e):
    return ".".join(x or "" for x in (e.schema, e.table, e.column))


def joins_of(spark, texts):
    """Joins per text: (kind, equalities, condition)."""
    df = spark.createDataFrame([(t, t) for t in texts], "file string, sql string")
    out = {t: [] for t in texts}
    for r in discovery.extract_joins(df).orderBy(*discovery.SEEN).collect():
        out[r.file].append(
            (r.kind, [f"{_end(e.left)}={_end(e.right)}" for e in r.equalities], r.on_text)
        )
    return out


CASES = {
    # alias, quoting and schema
    "select 1 from s.a x left outer join s.b y on x.i = y.j": [("LEFT", ["s.a.i=s.b.j"])],
    "select 1 from [s].[a] join `b` on [a].[i]=`b`.[j]": [("JOIN", [".".join(("s", "a", "i")) + "=.b.j"])],
    "select 1 from cat.s.a x semi join cat..b y on x.i = y.j": [("SEMI", ["s.a.i=.b.j"])],
    "select 1 from [Order Details] o join b on o.[Order ID] = b.id": [
        ("JOIN", [".Order Details.Order ID=.b.id"])
    ],
    'select 1 from "select" s join "from" f on s."on" = f."where"': [
        ("JOIN", [".select.on=.from.where"])
    ],
    "select 1 from a left semi join b on A.i = B.j": [("LEFT", [".a.i=.b.j"])],
    "select 1 from a x join b y on z.i = y.j": [("JOIN", [".z.i=.b.j"])],
    "select 1 from a join b on i = b.j": [("JOIN", ["..i=.b.j"])],
    # an element of a column is no column; a bracket behind a keyword is a name
    "select 1 from f join d on f.arr[1] = d.id and f.k = d.k": [("JOIN", [".f.k=.d.k"])],
    "select 1 from f join d on f.m['k'] = d.id": [],
    "select 1 from f join d on[f].[k]=[d].[k]": [("JOIN", [".f.k=.d.k"])],
    # any white space separates
    "select f.x,\u0085 d.y from\u2028f join\u0085d on\u00a0f.k = d.k": [("JOIN", [".f.k=.d.k"])],
    # what drops out
    "select 1 from a cross join b, c natural join d join e using (id)": [],
    "select 1 from a join (select id from b) q on a.id = q.id": [],
    "select 1 from a, b where a.i = b.i": [],
    "update a set x = 1 from a join b on a.i = b.i": [],
    # operands
    "select 1 from a join b on a.i = 1.5 and a.i = b.j + 1 and a.k <=> b.k and a.l >= b.l and a.m != b.m": [],
    "select 1 from a join b on lower(a.i) = b.i and a.j = b.j::int and a.k = 'x = b.k'": [],
    "select 1 from a join b on not a.i = b.i or (a.j = b.j and case when a.k = b.k then true end)": [
        ("JOIN", [".a.i=.b.i", ".a.j=.b.j", ".a.k=.b.k"])
    ],
    "select 1 from a join b on a.i between 1 and 2 and a.j = b.j": [("JOIN", [".a.j=.b.j"])],
    # shallowest first: of three conjuncts the last one leads
    "select 1 from a join b on a.i = b.i and a.j = b.j and a.k = b.k": [
        ("JOIN", [".a.k=.b.k", ".a.i=.b.i", ".a.j=.b.j"])
    ],
    "select 1 from a join b on a.i = b.i and a.j = b.j": [("JOIN", [".a.i=.b.i", ".a.j=.b.j"])],
    # scopes
    "with c as (select 1 from a join b on a.i = b.i) select 1 from c join d on c.x = d.x": [
        ("JOIN", [".c.x=.d.x"]), ("JOIN", [".a.i=.b.i"]),
    ],
    "select 1 from a join b on a.i = b.i union all select 1 from c join d on c.i = d.i": [
        ("JOIN", [".a.i=.b.i"]), ("JOIN", [".c.i=.d.i"]),
    ],
    "select (select max(z) from z) from a where exists (select 1 from b x join c on x.i = c.i)": [
        ("JOIN", [".b.i=.c.i"])
    ],
    # tables inside a derived FROM are visible outside, before the joined ones
    "select 1 from (select x.v from s.a x) q join b x on x.i = b.i": [("JOIN", ["s.a.i=.b.i"])],
    "select extract(year from a.d), trim(both ' ' from a.s) from a join b on a.i = b.i": [
        ("JOIN", [".a.i=.b.i"])
    ],
    # statements
    "select ';' from a; -- join x on y.i = z.i\n select 1 from a join b on a.i = b.i /* ; */": [
        ("JOIN", [".a.i=.b.i"])
    ],
    "drop view v create view v as select 1 from a join b on a.i = b.i": [("JOIN", [".a.i=.b.i"])],
    "select {{ x }} from a join b on a.i = b.i and a.k = {{k}}": [("JOIN", [".a.i=.b.i"])],
    "select 1 from a inner join b with (nolock) on a.i = b.i where 1 = 1": [("INNER", [".a.i=.b.i"])],
}


TEXT = "select 1 from a join b on ( a.i=b.i\n  and coalesce(a.x , 1)>=b.x ) or a.s='it''s (; x'"
DEEP = "select 1 from a join b on " + "(" * 40 + "a.i = b.i" + ")" * 40
LONG = "select '" + "x''" * 20_000 + "' from a join b on a.i = b.i"


@pytest.fixture(scope="module")
def found(spark):
    return joins_of(spark, [*CASES, TEXT, DEEP, LONG])


@pytest.mark.parametrize("sql", list(CASES))
def test_joins(found, sql):
    assert [(k, e) for k, e, _ in found[sql]] == CASES[sql]


def test_condition_text(found):
    shown = "(a.i = b.i AND coalesce(a.x, 1)>=b.x) OR a.s = 'it''s (; x'"
    assert found[TEXT][0][2] == shown


def test_deep_nesting_and_long_literals(found):
    assert found[DEEP][0][1] == [".a.i=.b.i"]
    assert found[LONG][0][1] == [".a.i=.b.i"]


def test_two_spellings_are_one_edge(spark):
    df = spark.createDataFrame(
        [
            ("a.sql", "SELECT * FROM stg.orders o LEFT JOIN stg.customers c ON o.customer_id = c.id"),
            ("b.sql", "SELECT * FROM [stg].[Orders] INNER JOIN [stg].[customers] ON [customers].[id] = [Orders].[customer_id]"),
            ("c.sql", "SELECT 1 FROM t"),
        ],
        "file string, sql string",
    )
    edges, found = discovery.discover(df)
    (edge,) = edges.collect()
    assert edge.id == "stg.customers.id|stg.orders.customer_id"
    assert (edge.left.column, edge.n_occurrences, edge.first_file) == ("customer_id", 2, "a.sql")
    assert {r.file for r in found.collect()} == {"a.sql", "b.sql"}
    assert discovery.scan_statistics(df).first().files_scanned == 3
    keys = {r.table_key for r in discovery.edges_by_table(edges).collect()}
    assert keys == {"stg.orders", "stg.customers"}


def test_repeats_in_a_file_count_once_and_later_extras_are_ignored(spark):
    one = "select 1 from a join b on a.i = b.i and a.d = b.d"
    df = spark.createDataFrame(
        [("1.sql", f"{one}; {one}"), ("2.sql", "select 1 from a join b on a.i = b.i")],
        "file string, sql string",
    )
    edges, found = discovery.discover(df)
    (edge,) = edges.collect()
    assert edge.n_occurrences == 2 and len(edge.extra) == 1
    assert found.count() == 2


def test_unbalanced_brackets_are_reported(spark):
    df = spark.createDataFrame(
        [("1.sql", "select (1; select 2)"), ("2.sql", "select (1)")], "file string, sql string"
    )
    (row,) = discovery.scan_errors(df).collect()
    assert row.file == "1.sql" and "statement 0" in row.message and "statement 1" in row.message


def test_reading_a_folder(spark, tmp_path):
    def put(name, data):
        p = tmp_path / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(data)

    put("real.sql", b"select 1")
    put("sub dir/a+b.SQL", b"select \xff 2")
    put("node_modules/hidden.sql", b"select 3")
    put("cache/x.sql", b"select 4")
    put("notes.txt", b"select 5")
    got = corpus.read_sql_corpus(spark, str(tmp_path), also_ignored=["cache"])
    assert {r.file: r.sql for r in got.collect()} == {
        "real.sql": "select 1",
        "sub dir/a+b.SQL": "select � 2",
    }
    relative = corpus.read_sql_corpus(spark, f"file:{tmp_path}/sub dir/")
    assert [r.file for r in relative.collect()] == ["a+b.SQL"]
    with pytest.raises(ValueError, match="pattern"):
        corpus.read_sql_corpus(spark, f"{tmp_path}/*")


def test_edge_store(spark, tmp_path):
    df = spark.createDataFrame(
        [("1.sql", "select 1 from s.a join s.b on a.i = b.i")], "file string, sql string"
    )
    edges, _ = discovery.discover(df)
    corpus.write_edge_store(discovery.edges_by_table(edges), str(tmp_path / "store"))
    (row,) = corpus.read_edges_of(spark, str(tmp_path / "store"), "S", "B").collect()
    assert row.id == "s.a.i|s.b.i"


def test_names_of_many_parts(spark):
    deep = "p." * 2000
    texts = {
        "select 1 from p.d.s.a join p.d.s.b on p.d.s.a.i = p.d.s.b.j": ["s.a.i=s.b.j"],
        "select 1 from p.d.a x join p.d.b y on x.k.l.m.i = y.j": [".m.i=d.b.j"],
        "select 1 from u.v.w.x.s.a join u.v.w.x.y.s.b z on a.i = z.j": ["s.a.i=s.b.j"],
        f"select 1 from {deep}s.a x join {deep}s.b on x.i = {deep}s.b.j": ["s.a.i=s.b.j"],
    }
    found = joins_of(spark, list(texts))
    assert {t: found[t][0][1] if found[t] else None for t in texts} == texts


def test_conditions_at_the_end_close_the_innermost_join(spark):
    rows = [
        ("two.sql", "select * from a join b join c on b.i = c.i on a.j = b.j"),
        ("three.sql", "select * from a left join b inner join c full join d on c.k = d.k on b.i = c.i on a.j = b.j where 1 = 1"),
        ("mixed.sql", "select * from a join b on a.i = b.i join c join d on c.k = d.k on b.j = c.j cross join e join f on f.z = a.z"),
        ("comma.sql", "select * from x join y, a join b on a.i = b.i"),
        ("using.sql", "select * from a join b using (i) join c join d on c.k = d.k on a.j = c.j"),
    ]
    joins = discovery.extract_joins(spark.createDataFrame(rows, "file string, sql string")).collect()
    got = {(r.file, r.kind, r.right_table, r.on_text) for r in joins}
    assert got == {
        ("two.sql", "JOIN", "c", "b.i = c.i"), ("two.sql", "JOIN", "b", "a.j = b.j"),
        ("three.sql", "FULL", "d", "c.k = d.k"), ("three.sql", "INNER", "c", "b.i = c.i"), ("three.sql", "LEFT", "b", "a.j = b.j"),
        ("mixed.sql", "JOIN", "b", "a.i = b.i"), ("mixed.sql", "JOIN", "d", "c.k = d.k"),
        ("mixed.sql", "JOIN", "c", "b.j = c.j"), ("mixed.sql", "JOIN", "f", "f.z = a.z"),
        ("comma.sql", "JOIN", "b", "a.i = b.i"),
        ("using.sql", "JOIN", "d", "c.k = d.k"), ("using.sql", "JOIN", "c", "a.j = c.j"),
    }


def test_repeated_texts_and_statements_are_read_once(spark, monkeypatch):
    texts = [f"select 1 from a join b{i} on a.i = b{i}.i" for i in range(3)]
    rows = [(f"{n:03}.sql", texts[n % 3]) for n in range(60)]
    bundles = [(f"{n}.sql", f"select {n}; {texts[n % 3]}; {texts[0]}") for n in range(9)]
    read, counts = discovery._read, []

    def counted(statements):
        counts.append(statements.count())
        return read(statements)

    monkeypatch.setattr(discovery, "_read", counted)
    shape = "file string, sql string"
    edges, found = discovery.discover(spark.createDataFrame(rows, shape))
    assert {(r.file, r.right.table) for r in found.collect()} == {(f"{n:03}.sql", f"b{n % 3}") for n in range(60)}
    assert {(r.first_file, r.n_occurrences) for r in edges.collect()} == {(f"00{i}.sql", 20) for i in range(3)}
    joins = discovery.extract_joins(spark.createDataFrame(rows, shape))
    assert joins.groupBy("right_table").count().collect() and joins.count() == 60
    # files that differ, of statements that repeat
    edges, found = discovery.discover(spark.createDataFrame(bundles, shape))
    assert sorted((r.right.table, r.n_occurrences, r.first_file) for r in edges.collect()) == [
        ("b0", 9, "0.sql"), ("b1", 3, "1.sql"), ("b2", 3, "2.sql"),
    ]
    assert sorted((r.file, r.stmt_no) for r in found.collect()) == sorted(
        [(f"{n}.sql", 1) for n in range(9)] + [(f"{n}.sql", 2) for n in range(9) if n % 3]
    )
    assert counts == [3, 3, 3]
