from pyspark.sql import functions as F

from sparkloom.functions import checks, classify, extract, paths, scoring, text


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'binary' if isinstance(v, bytes) else 'string'}" for k, v in values.items())) if values else spark.range(1)
    return df.select(column.alias("x")).first()["x"]


def test_paths(spark):
    p = F.col("p")
    assert one(spark, paths.normalize_path(p), p=".\\a\\\\b/") == "a/b"
    assert one(spark, paths.to_relative_path(p, F.lit("/r")), p="/r/a/b.c") == "a/b.c"
    assert one(spark, paths.to_relative_path(p, F.lit("/r")), p="/rest/a") == "/rest/a"
    assert one(spark, paths.extension(p), p="a/B.JSP") == ".jsp"
    assert one(spark, paths.extension(p), p=".profile") == ""
    assert one(spark, paths.stem(p), p="x/a.b.c") == "a.b"
    assert one(spark, paths.canonical_path(p, ("web",)), p="C:\\x\\web\\a.jsp") == "/a.jsp"
    assert one(spark, paths.route_id(F.lit("/hr/*"), p), p="list*") == "route_hr_listSTAR"
    assert one(spark, paths.route_id(F.lit(None).cast("string"), p), p="/rest/*") == "route__rest_STAR"
    assert one(spark, paths.object_token(p), p="[dbo].[P](1)") == "p"
    assert one(spark, paths.resolved_target(F.lit("a/b/c.jsp"), p), p="../d.jsp?x=1") == "a/d.jsp"
    assert one(spark, paths.business_domain(p), p="/overtime/x") == "timekeeping"
    assert one(spark, paths.business_domain(p), p="/x/payroll") == "payroll"
    assert one(spark, paths.business_domain(p), p="/") == "general"
    assert one(spark, paths.menu_path(F.array(F.lit("a"), p)), p="/x/y/z/w") == "x > y > z"


def test_globs():
    import re

    assert re.search(paths.glob_regex("com.**.dao.*"), "com.a.b.dao.X")
    assert not re.search(paths.glob_regex("com.**.dao.*"), "com.a.dao.x.y")
    assert re.search(paths.glob_regex("*.jsp"), "a/b.jsp")
    assert paths.expand_braces("*.{a,b}") == ["*.a", "*.b"]


def test_exclusion_is_by_substring(spark):
    assert one(spark, paths.excluded(F.col("p"), ["**/test/**"]), p="a/test/b")
    assert one(spark, paths.excluded(F.col("p"), ["test"]), p="latest/b")


def test_text(spark):
    t = F.col("t")
    assert one(spark, text.canonical_role(t), t="role_HR Admin!") == "HRAdmin"
    assert one(spark, text.canonical_role(t), t="ROLE_getsecurity") == "getSecurity"
    assert one(spark, text.canonical_role(t), t=" ") is None
    assert one(spark, text.roles_in_expression(t), t="hasRole('A') or hasAnyRole('B', \"C\")") == ["A", "B", "C"]
    assert one(spark, text.humanize(t), t="employee_listAction") == "Employee list"
    assert one(spark, text.split_batches(t), t="select CATEGORY\nGO\nselect 2") == ["select CATEGORY", "select 2"]
    assert one(spark, text.clean_statement(t), t="a -- b\n/* c\n*/ d").split() == ["a", "d"]
    assert one(spark, text.column_names(t), t="SELECT DISTINCT a, b.c AS d FROM t") == ["b.c"]
    assert one(spark, text.first_json(t), t='x {"a": {"b": 1}} y') == '{"a": {"b": 1}}'
    assert one(spark, text.first_json(t), t="none") is None
    assert one(spark, text.deep_merged(t, F.lit('{"a": {"c": 2}}')), t='{"a": {"b": 1}}') == '{"a": {"b": 1, "c": 2}}'
    assert one(spark, text.has_keys(t, ["a"]), t='{"a": 1}') and not one(spark, text.has_keys(t, ["b"]), t="no")


def test_classes(spark):
    c = F.col("c")
    assert one(spark, classify.file_type(c), c=".jspx") == "web"
    assert one(spark, classify.language_of(c), c=".zzz") == "other"
    assert one(spark, classify.to_architecture(c), c="DataAccess") == "data_access"
    rules = [("a", "*x*"), ("b", "*xy*")]
    assert one(spark, classify.first_match(c, rules), c="xy") == "a"
    assert one(spark, classify.last_match(c, rules), c="xy") == "b"
    assert one(spark, classify.component_type(F.lit(""), c), c="/a/b.jsp") == "page"


def test_scores(spark):
    conf = lambda m, n: one(spark, scoring.confidence_boost(F.lit(m), F.lit(n)))
    assert [conf(0.9, 3), conf(0.75, 2), conf(0.65, 1), conf(0.9, 0), conf(0.5, 9)] == [0.05, 0.05 * 0.7, 0.025, 0, 0]
    assert one(spark, scoring.best({"a": F.lit(2), "b": F.lit(2)})) == "a"
    assert one(spark, scoring.best({"a": F.lit(0)})) is None


PAGE = """<%@ page import="x" %><%@ include file="/head.jspf" %><jsp:include page="menu.jsp"/>
<% int a = 1; %><%= a %>${user.name}<c:if test="x"><form action="/save.do"><input name="id" required></form>
<iframe src="part.jsp"></iframe><meta http-equiv="refresh" content="0;url=next.jsp"><script>window.location = 'go.jsp';
function run() {}</script><% request.getRequestDispatcher("/end.jsp") %> <% if (request.isUserInRole("Admin")) {} %>"""


def test_pages(spark):
    p = F.col("p")
    get = lambda c: one(spark, c, p=PAGE)
    assert get(extract.includes(p)) == ["/head.jspf", "menu.jsp"]
    assert get(extract.directives(p)) == ["page", "include"]
    assert get(extract.expressions(p)) == [" a "]
    assert len(get(extract.scriptlets(p))) == 3
    assert get(extract.el_expressions(p)) == ["user.name"]
    assert get(extract.namespaced_tags(p, ("jsp",))) == ["c:if"]
    assert get(extract.form_actions(p)) == ["/save.do"] and get(extract.form_fields(p)) == ["id"]
    assert get(extract.iframes(p)) == ["part.jsp"] and get(extract.meta_refresh(p)) == ["next.jsp"]
    assert get(extract.js_navigations(p)) == ["go.jsp"] and get(extract.dispatcher_calls(p)) == ["/end.jsp"]
    assert get(extract.role_tokens(p)) == ["Admin"] and get(extract.js_functions(p)) == ["run"]
    assert get(checks.scriptlet_balance(p)) == 0
    assert one(spark, extract.attributes(p), p='<input name="id" required class=\'a b\'>') == {"name": "id", "required": "", "class": "a b"}


def test_configuration(spark):
    x = F.col("x")
    web = '<w:web-app xmlns:w="u"><w:servlet><w:servlet-name>s</w:servlet-name></w:servlet><w:servlet-mapping><w:servlet-name>s</w:servlet-name><w:url-pattern>/a/*</w:url-pattern></w:servlet-mapping></w:web-app>'
    assert one(spark, extract.web_xml(x)["mapping_urls"], x=web) == ["/a/*"]
    assert one(spark, extract.config_kind(x), x="WEB-INF/validator-rules.xml") == "validator_rules"
    assert [tuple(r) for r in one(spark, extract.properties(x), x="# c\na = 1=2\nb\n")] == [("a", "1=2")]
    assert one(spark, extract.gradle(x)["dependencies"], x="implementation 'g:a:1'") == ["g:a:1"]
    assert one(spark, checks.unclosed_tag(x), x="<a><b></a>") == "a" and one(spark, checks.unclosed_tag(x), x="<a><b/></a>") is None


CODE = 'package a.b;\nimport java.util.List;\nimport broken\n@Path("/x")\npublic class C extends D implements E, F {\n private int n = 0;\n @RolesAllowed({"R1", "R2"}) @GET public List<String> go() { if (n > 0) { svc.call(); } String s = "SELECT a FROM t1"; return null; }\n}'


def test_code(spark):
    c = F.col("c")
    j = {k: one(spark, v, c=CODE) for k, v in extract.java_type(c).items()}
    assert j["package"] == "a.b" and j["types"] == ["C"] and j["extends"] == ["D"] and j["implements"] == ["E", "F"]
    assert j["roles"] == ["R1", "R2"] and j["rest_paths"] == ["/x"] and j["verbs"] == ["GET"] and j["methods"] == ["go"] and j["fields"] == ["n"]
    assert j["sql"] == ["SELECT a FROM t1"] and "svc.call" in j["instance_calls"]
    assert one(spark, extract.decision_points(c), c=CODE) == 2
    assert len(one(spark, checks.java_imports_bad(c), c=CODE)) == 1
    assert one(spark, checks.brace_depth(c), c=CODE) == 0 and one(spark, checks.brace_depth(c), c='{ "}" ') == 1


def test_encodings(spark):
    b = F.col("b")
    for data, name in ((b"\xef\xbb\xbfa", "utf-8-sig"), (b"\xff\xfea\0", "utf-16-le"), (b"\xff\xfe\0\0a\0\0\0", "utf-32-le"), ("é".encode(), "utf-8"), (b"\xe9", "latin-1")):
        assert one(spark, checks.encoding_of(b), b=data) == name
        assert one(spark, checks.decoded(b, checks.encoding_of(b)), b=data) in ("a", "é")
    assert not one(spark, checks.is_valid_text(F.col("t")), t="\x00\x00a")
