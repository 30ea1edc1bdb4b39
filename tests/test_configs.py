from pyspark.sql import functions as F

from sparkloom.functions import ddl
from sparkloom.operators import configs, pages, reports, security
from sparkloom.plans.registry import Chain, Stage, with_plugins


def docs(spark, text, path="x.xml"):
    return spark.createDataFrame([(path, text)], "path string, text string")


def test_tables_and_keys():
    t = ddl.read_table("CREATE TABLE [hr].[p] (id INT PRIMARY KEY, n DECIMAL(10, 2) NOT NULL DEFAULT 0, d VARCHAR(5) DEFAULT 'a,b', boss INT REFERENCES hr.p(id), CONSTRAINT k FOREIGN KEY (d, n) REFERENCES q (x, y), UNIQUE (d))")
    assert t["name"] == "hr.p" and [c["name"] for c in t["columns"]] == ["id", "n", "d", "boss"]
    assert [(c["type"], c["nullable"], c["default"]) for c in t["columns"]][:3] == [("INT", False, None), ("DECIMAL(10,2)", False, "0"), ("VARCHAR(5)", True, "'a,b'")]
    assert t["primary_key"] == ["id"] and t["foreign_keys"] == [{"columns": ["boss"], "references": "hr.p"}, {"columns": ["d", "n"], "references": "q"}]
    assert ddl.read_table("CREATE TABLE x")["columns"] == [] and ddl.read_table(None) is None


def test_sql_bodies(spark):
    df = docs(spark, "CREATE PROCEDURE dbo.p AS INSERT INTO t1 SELECT a FROM t2 JOIN t3 ON 1 = 1; DELETE FROM t4")
    assert df.select(ddl.procedure_of(F.col("text")).alias("x")).first()["x"] == "dbo.p"
    ops = df.select(ddl.operations_of(F.col("text")).alias("x")).first()["x"]
    assert {"INSERT:t1", "SELECT:t2", "DELETE:t4"} <= set(ops) and "SELECT:t4" not in ops
    assert df.select(ddl.tables_of(F.col("text")).alias("x")).count() == 1
    assert docs(spark, "INSERT INTO a SELECT b FROM c").select(ddl.statement_type(F.col("text")).alias("x")).first()["x"] == "INSERT"
    assert docs(spark, "CREATE VIEW v AS SELECT a.b, max(c) AS d, [e] FROM t").select(ddl.view_columns(F.col("text")).alias("x")).first()["x"] == ["b", "d", "e"]
    rows = spark.createDataFrame([("o", 2, "b"), ("o", 1, "a")], "name string, ord int, sql string")
    assert ddl.combined(rows, "name", "ord", "sql").first()["body"] == "a\nGO\nb"


STRUTS = """<struts><package name="p" namespace="/hr" extends="d"><action name="list" class="c.List" method="go"><result>/l.jsp</result></action><action name="save"/></package>
<package name="q"><action name="save" class="c.Save"/></package><constant name="struts.devMode" value="true"/><constant name="zzz" value="1"/>
<interceptor name="i" class="c.I"/><interceptor-stack name="s"><interceptor-ref name="i"/><interceptor-ref name="j"/></interceptor-stack></struts>"""


def test_packages(spark):
    d = docs(spark, STRUTS)
    got = {(r.group_name, r.action): (r.namespace, r["class"]) for r in configs.packages(d).collect()}
    assert got == {("p", "list"): ("hr", "c.List"), ("p", "save"): ("hr", "c.Save"), ("q", "save"): (None, "c.Save")}
    assert [(r.name, r.category) for r in configs.constants(d).collect()] == [("struts.devMode", "debug")]
    assert {(r.from_reference, r.to_reference) for r in configs.interceptors(d).collect()} == {("i", "c.I"), ("s", "i,j")}
    old = docs(spark, '<struts-config><action-mappings><action path="/go" type="c.Go" name="f"/></action-mappings></struts-config>')
    assert [tuple(r)[:2] for r in configs.action_mappings(old).collect()] == [("go", "c.Go")]


def test_tiles_and_validation(spark):
    t = docs(spark, '<tiles><definition name="a" path="/a.jsp" template="/t.jsp"><put name="body" value="/b.jsp"/></definition><definition name="b" extends="a"/></tiles>')
    assert {(r.from_reference, r.to_reference, r.mapping_type) for r in configs.template_definitions(t).collect()} == {("a", "/a.jsp", "template"), ("b", "a", "reference")}
    assert [(r.from_reference, r.component_type) for r in configs.tile_components(t).collect()] == [("a.body", "page")]
    assert configs.extends_edges(t).first()["to_reference"] == "a"
    v = docs(spark, '<f><form name="login"><field property="user" depends="required, mask"><var><var-name>mask</var-name><var-value>^x$</var-value></var><arg0 key="k"/></field></form><validator name="v" classname="c" method="m" depends="a, b"/></f>')
    assert {(r.validation_type, r.variables, r.error_message_key) for r in configs.validation_rules(v).collect()} == {("required", "", "k"), ("mask", "mask=^x$", "k")}
    assert configs.validator_definitions(v).first()["depends"] == ["a", " b"]
    m = docs(spark, '<server><mbean name="n" code="c"><depends>d1</depends><attribute name="x">1</attribute></mbean></server>')
    assert tuple(configs.services(m).first())[1:] == ("n", "c", "service", "jboss", "d1", "config_x")
    assert configs.servlet_mappings(docs(spark, "<broken")).count() == 0


def test_pages_and_roles(spark):
    m = spark.createDataFrame([("a.jsp", "b.jsp", "include"), ("a.jsp", "b.jsp", "include"), ("a.jsp", "c.jsp", "forward")], "from_path string, to_path string, kind string")
    assert {(r.to_id, r.type, r.confidence) for r in pages.view_edges(m).collect()} == {("jsp_b", "includesView", 0.9), ("jsp_c", "redirectsTo", 0.8)}
    p = spark.createDataFrame([("edit_user_now", "edit_*_*", "{1}x{2}"), ("a", "b", "{1}")], "token string, action string, method string")
    assert [r.method for r in pages.resolved_placeholders(p, "token", "action", "method").collect()] == ["userxnow", "{1}"]
    tokens = spark.createDataFrame([("p1", "/hr/list.do?x=1"), ("p1", "/a/save"), ("p2", "none")], "page string, token string")
    known = spark.createDataFrame([("r1", "hr/list"), ("r2", "/z/list"), ("r3", "/b/save.action")], "id string, action string")
    assert {(r.to_id, r.tier) for r in pages.calls(tokens, known).collect()} == {("r1", "equal"), ("r3", "segment")}
    roles = spark.createDataFrame([("c", "class", "ROLE_A, B"), ("c", "method", "A")], "source_id string, place string, role string")
    assert {(r.to_id, r.confidence) for r in security.role_edges(roles).collect()} == {("role_A", 0.95), ("role_B", 0.9)}
    spans = spark.createDataFrame([("f", "t", "text", 1, 1), ("f", "t", "tag", 9, 10)], "from_id string, to_id string, kind string, line int, end_line int")
    assert security.best_evidence(spans).first()["line"] == 9
    assert reports.text_report([("title", m)]).count() == 4


def test_extension_points(spark):
    df = spark.range(3)
    chain = Chain(lambda d: F.lit("rest")).register("even", lambda d: F.when(F.col("id") % 2 == 0, "even"))
    assert [r.k for r in chain.apply(df, "k").orderBy("id").collect()] == ["even", "rest", "even"]
    kept = {}
    Stage("s", lambda d: {"in": d}, lambda t: {"out": t["in"].where("id > 0")}).run(lambda s, n, d: kept.update({(s, n): d.count()}), df)
    assert kept == {("s", "out"): 2} and with_plugins(df, [lambda d: d.limit(1)]).count() == 1


CODE = '''package a.b;
@Path("/emp") @Service
public class Emp extends Base implements Run, java.io.Serializable {
  @Autowired private EmpManager manager;
  private OtherService other = null;
  private int n;
  @OneToMany(mappedBy = "x") private List<Order> orders;
  @RolesAllowed({"A", "B"}) @GET @Path("/all") public String all() { Util.go(); manager.list(); return "SELECT a FROM t"; }
  @POST public void save(String q) { st.execute(q); ctx.lookup("java:x"); if (r.isUserInRole("C")) {} String c = "{call p.q(?)}"; }
  @Before("execution(* c.D.m(..))") void before() {}
}'''


def test_code_edges(spark):
    from sparkloom.functions import checks, scoring
    from sparkloom.operators import code

    d = docs(spark, CODE, "Emp.java")
    edges = {(r.mapping_type, r.to_reference) for r in code.code_mappings(d).collect()}
    assert {("extends", "Base"), ("implements", "Run"), ("implements", "java.io.Serializable"), ("injects", "EmpManager"), ("references", "OtherService"), ("OneToMany", "Order"), ("component", "Service"), ("static_call", "Util.go"), ("instance_call", "manager.list"), ("lookup", "java:x"), ("secured", "A"), ("secured", "B"), ("security_check", "C"), ("advice", "c.D.m")} <= edges
    assert ("references", "int") not in edges
    assert {r.from_reference for r in code.code_mappings(d, ["c"]).collect()} == {"a.b.Emp"}
    assert {(r.verb, r.full_path, r.method) for r in code.endpoints(code.typed(d)).collect()} == {("GET", "/emp/all", "all"), ("POST", "/emp", "save")}
    assert {(r.kind, r.text, r.line) for r in code.sql_executions(code.typed(d)).collect()} == {("sql", "SELECT a FROM t", 8), ("procedure", "p.q", 9), ("dynamic", "q", 9)}
    assert code.orchestrators(code.typed(d)).first()["score"] == 2
    assert d.select(code.layer_of(F.col("text")).alias("x")).first()["x"] == "Service"
    kind, confidence, level = scoring.page_class(F.col("text"))
    page = docs(spark, "<form><c:forEach><c:out/></form>").select(kind.alias("k"), confidence.alias("c"), level.alias("l")).first()
    assert tuple(page)[0] == "form" and abs(page.c - 0.95) < 1e-9 and page.l == "moderate"
    bad = spark.createDataFrame([("java", "import x\nclass A {"), ("sql", "select 'a"), ("xml", "<a/>")], "l string, t string").select("l", checks.syntax_issues(F.col("l"), F.col("t")).alias("i"))
    assert {r.l: r.i for r in bad.collect()} == {"java": ["braces", "imports"], "sql": ["quotes"], "xml": []}


def test_page_calls_read_the_links_of_every_page(spark, sf_dir, monkeypatch):
    """A link to another page's path is a call, as SQL has it too; calls made from the keys stay."""
    from sparkloom.plans import catalog, model

    pages_ = spark.createDataFrame([(0, "http://a/one", "<a href='/two'>x</a>"), (1, "http://a/mid", ""), (2, "http://a/two", "<a href='/f/one?q'>x</a>")], "page_id long, url string, html string")
    monkeypatch.setattr(model, "table", lambda *_: pages_)
    got = {(r.from_id, r.to_id, r.tier) for r in catalog.QUERIES["page_calls"](spark, sf_dir).collect()}
    assert got == {("page_0", "w_2", "equal"), ("page_0", "w_1", "segment"), ("page_2", "w_0", "segment")}
    assert "FROM links" in catalog.SQL["page_calls"]
