"""Queries of configuration documents, one of each kind a supplier; {n} stands for the supplier's key. The SQL tells from
the suppliers' rows what each document says."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkloom.functions import extract, markup
from sparkloom.operators import configs
from sparkloom.plans import model
from sparkloom.plans.catalog import _filled, query

WEB = "<web-app><context-param><param-name>p{n}</param-name><param-value>v{n}</param-value></context-param><context-param><param-name>q</param-name><param-value> w </param-value></context-param><session-config><session-timeout>{n}</session-timeout></session-config></web-app>"
STRUTS = """<struts><package name="p{n}" namespace="/hr{n}/" extends="d"><action name="list{n}" class="c.List{n}" method="go"><result>/l.jsp</result></action></package>
<constant name="struts.devMode" value="{n}"/><constant name="struts.i18n.x" value="a"/><constant name="zzz" value="1"/>
<interceptor name="i{n}" class="c.I"/><interceptor-stack name="s"><interceptor-ref name="i{n}"/><interceptor-ref name="j"/></interceptor-stack></struts>"""
OLD = '<struts-config><action-mappings><action path="/go{n}" type="c.Go{n}" name="f"/><action path="/x"/></action-mappings></struts-config>'
TILES = '<tiles><definition name="a{n}" path="/a.jsp" template="/t.jsp"><put name="body" value="/b{n}.jsp"/></definition><definition name="b" extends="a{n}"/></tiles>'
FORMS = '<f><form name="login{n}"><field property="user" depends="required, mask"><var><var-name>mask</var-name><var-value>^{n}$</var-value></var><arg0 key="k"/></field></form><validator name="v{n}" classname="c" method="m" depends="a, b" msg="e"/></f>'
SERVICES = '<s:server xmlns:s="u"><s:mbean name="n{n}" code="c{n}"><s:depends>d{n}</s:depends><s:depends> e </s:depends><s:attribute name="x">{n}</s:attribute></s:mbean><s:mbean name="m" code="k"/><s:mbean name="lost"/></s:server>'
BEANS = '<beans><bean id="b{n}" class="c.B{n}"/><bean id="z" class="c.Z"><property name="x"/></bean></beans>'
POM = "<project><dependencies><dependency><groupId>g</groupId><artifactId>a{n}</artifactId><version>1.{n}</version><scope>test</scope></dependency><dependency><groupId>h</groupId><artifactId>b</artifactId></dependency></dependencies></project>"
PROPERTIES = "# note\n! more\na.b{n} = c = {n}\n\nempty{n}=\nnone\n"
GRADLE = "plugins { id 'java{n}' }\napply plugin: \"war\"\ndependencies { implementation 'g:a:{n}'\n testImplementation(\"t:u:1\") }"
S = "FROM supplier"


@query(f"SELECT 's' || s_suppkey || '/web.xml' AS path, unnest(['p' || s_suppkey, 'q']) AS name, unnest(['v' || s_suppkey, 'w']) AS value {S}")
def config_context_params(spark, d):
    return configs.context_params(_filled(spark, d, WEB, "/web.xml"))


@query(f"SELECT 's' || s_suppkey || '/web.xml' AS path, s_suppkey::int AS timeout {S}")
def config_sessions(spark, d):
    return configs.session_config(_filled(spark, d, WEB, "/web.xml"))


@query(f"SELECT 'p' || s_suppkey AS group_name, 'hr' || s_suppkey AS namespace, 'd' AS extends, 'list' || s_suppkey AS action, 'c.List' || s_suppkey AS class, 'go' AS method {S}")
def config_packages(spark, d):
    return configs.packages(_filled(spark, d, STRUTS, "/struts.xml"))


@query(f"SELECT 's' || s_suppkey || '/struts.xml' AS path, unnest(['struts.devMode', 'struts.i18n.x']) AS name, unnest([s_suppkey::varchar, 'a']) AS value, unnest(['debug', 'localisation']) AS category {S}")
def config_constants(spark, d):
    return configs.constants(_filled(spark, d, STRUTS, "/struts.xml"))


@query(f"SELECT unnest(['i' || s_suppkey, 's']) AS from_reference, unnest(['c.I', 'i' || s_suppkey || ',j']) AS to_reference, unnest(['interceptor', 'interceptor_stack']) AS mapping_type {S}")
def config_interceptors(spark, d):
    return configs.interceptors(_filled(spark, d, STRUTS, "/struts.xml")).select("from_reference", "to_reference", "mapping_type")


@query(f"SELECT 'go' || s_suppkey AS from_reference, 'c.Go' || s_suppkey AS to_reference, 'f' AS form_name {S}")
def config_actions(spark, d):
    return configs.action_mappings(_filled(spark, d, OLD, "/struts-config.xml")).select("from_reference", "to_reference", "form_name")


@query(f"SELECT unnest(['a' || s_suppkey, 'b']) AS from_reference, unnest(['/a.jsp', 'a' || s_suppkey]) AS to_reference, unnest(['template', 'reference']) AS mapping_type {S}")
def config_templates(spark, d):
    return configs.template_definitions(_filled(spark, d, TILES, "/tiles.xml")).select("from_reference", "to_reference", "mapping_type")


@query(f"SELECT 'b' AS from_reference, 'a' || s_suppkey AS to_reference, 'extends' AS mapping_type, NULL AS component_type {S} UNION ALL SELECT 'a' || s_suppkey || '.body', '/b' || s_suppkey || '.jsp', 'component', 'page' {S}")
def config_tiles(spark, d):
    docs = _filled(spark, d, TILES, "/tiles.xml")
    up = configs.extends_edges(docs).withColumn("component_type", F.lit(None).cast("string"))
    return up.unionByName(configs.tile_components(docs)).select("from_reference", "to_reference", "mapping_type", "component_type")


@query(f"SELECT 'login' || s_suppkey AS form_name, 'user' AS field_reference, unnest(['required', 'mask']) AS validation_type, unnest(['', 'mask=^' || s_suppkey || '$']) AS variables, 'k' AS error_message_key {S}")
def config_validation_rules(spark, d):
    return configs.validation_rules(_filled(spark, d, FORMS, "/validation.xml")).select("form_name", "field_reference", "validation_type", "variables", "error_message_key")


@query(f"SELECT 'v' || s_suppkey AS name, 'c' AS class, 'm' AS method, 'a| b' AS depends, 'e' AS msg {S}")
def config_validators(spark, d):
    v = configs.validator_definitions(_filled(spark, d, FORMS, "/validator-rules.xml"))
    return v.select("name", "class", "method", F.array_join("depends", "|").alias("depends"), "msg")


@query(
    f"SELECT 's' || s_suppkey || '/jboss-service.xml' AS path, 'n' || s_suppkey AS from_reference, 'c' || s_suppkey AS to_reference, 'd' || s_suppkey || ',e' AS depends, 'config_x=' || s_suppkey AS attributes {S} "
    f"UNION ALL SELECT 's' || s_suppkey || '/jboss-service.xml', 'm', 'k', '', '' {S}"
)
def config_services(spark, d):
    docs = _filled(spark, d, SERVICES, "/jboss-service.xml").withColumnRenamed("path", "file")
    return configs.generic_services(markup.element_rows(docs, "file", F.col("text")), "file").withColumnRenamed("file", "path")


@query(f"SELECT unnest(['b' || s_suppkey, 'z']) AS from_reference, unnest(['c.B' || s_suppkey, 'c.Z']) AS to_reference {S}")
def config_beans(spark, d):
    return configs.beans(_filled(spark, d, BEANS, "/applicationContext.xml")).select("from_reference", "to_reference")


@query(f"SELECT unnest(['g', 'h']) AS group_name, unnest(['a' || s_suppkey, 'b']) AS artifact, unnest(['1.' || s_suppkey, NULL]) AS version, unnest(['test', NULL]) AS scope {S}")
def config_dependencies(spark, d):
    return configs.dependencies(_filled(spark, d, POM, "/pom.xml")).select(F.col("group").alias("group_name"), "artifact", "version", "scope")


@query(f"SELECT 's' || s_suppkey || '/a.properties' AS path, unnest(['a.b' || s_suppkey, 'empty' || s_suppkey]) AS key, unnest(['c = ' || s_suppkey, '']) AS value {S}")
def config_properties(spark, d):
    p = _filled(spark, d, PROPERTIES, "/a.properties")
    return p.select("path", F.explode(extract.properties(F.col("text"))).alias("p")).select("path", "p.key", "p.value")


@query(f"SELECT 's' || s_suppkey || '/build.gradle' AS path, 'java' || s_suppkey || ',war' AS plugins, 'g:a:' || s_suppkey || ',t:u:1' AS dependencies {S}")
def config_gradle(spark, d):
    g = _filled(spark, d, GRADLE, "/build.gradle")
    return g.select("path", *(F.array_join(c, ",").alias(k) for k, c in extract.gradle(F.col("text")).items()))


#: Names of files and their kinds, as the first rule that fits tells.
KINDS = (("WEB-INF/web.xml", "web_xml"), ("struts-x.xml", "struts"), ("tiles-defs.xml", "tiles"), ("validator-rules.xml", "validator_rules"), ("validation.xml", "validation"), ("pom.xml", "maven"), ("jboss-web2.xml", "jboss"), ("build.xml", "ant"), ("applicationContext-a.xml", "spring"), ("persistence.xml", "persistence"), ("build.gradle.kts", "gradle"), ("a.properties", "properties"), ("b.yml", "yaml"), ("c.xml", "xml"), ("d.txt", "unknown"))


@query("SELECT p_partkey, [" + ", ".join(f"'{k}'" for _, k in KINDS) + f"][p_partkey % {len(KINDS)} + 1] AS kind FROM part")
def config_kinds(spark, d):
    p = model.table(spark, d, "part")
    name = F.element_at(F.array(*(F.lit(f) for f, _ in KINDS)), (F.col("p_partkey") % len(KINDS) + 1).cast("int"))
    return p.select("p_partkey", extract.config_kind(F.concat(F.lit("p"), "p_partkey", F.lit("/"), name)).alias("kind"))
