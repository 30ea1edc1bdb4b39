"""Rows out of text: markup, scripts, styles, configuration, code. Arrays of columns to explode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Elements that are counted in pages.
ELEMENTS = ("div", "span", "table", "tr", "td", "th", "ul", "li", "p", "h1", "h2", "h3", "iframe")


def all_of(text: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def element_counts(html: Column) -> dict[str, Column]:
    return {tag: F.regexp_count(html, F.lit(f"(?i)<{tag}[^>]*>")) for tag in ELEMENTS}


def links(html: Column) -> Column:
    return all_of(html, r"(?i)<a\s[^>]*href=[\"']([^\"']*)[\"']")


def iframes(html: Column) -> Column:
    return all_of(html, r"(?i)<iframe\s[^>]*src=[\"']([^\"']*)[\"']")


def meta_refresh(html: Column) -> Column:
    return all_of(html, r"(?i)<meta\s[^>]*http-equiv=[\"']refresh[\"'][^>]*url=([^\"'>\s]+)")


def js_navigations(html: Column) -> Column:
    return F.concat(all_of(html, r"(?:window[.])?location(?:[.]href)?\s*=\s*[\"']([^\"']+)[\"']"), all_of(html, r"location[.](?:assign|replace)\(\s*[\"']([^\"']+)[\"']"))


def dispatcher_calls(page: Column) -> Column:
    return all_of(page, r"getRequestDispatcher\(\s*[\"']([^\"']+)[\"']")


def includes(page: Column) -> Column:
    return F.concat(all_of(page, r"<%@\s*include\s+file=[\"']([^\"']+)[\"']"), all_of(page, r"<jsp:include\s+page=[\"']([^\"']+)[\"']"))


def directives(page: Column) -> Column:
    return all_of(page, r"<%@\s*(\w+)")


def scriptlets(page: Column) -> Column:
    return all_of(page, r"(?s)<%(?![@=!-])(.*?)%>")


def expressions(page: Column) -> Column:
    return all_of(page, r"(?s)<%=(.*?)%>")


def el_expressions(page: Column) -> Column:
    return all_of(page, r"\$\{([^}]*)\}")


def namespaced_tags(page: Column, skip: tuple[str, ...] = ()) -> Column:
    found = all_of(page, r"<(\w+:\w+)")
    return F.filter(found, lambda t: ~F.substring_index(t, ":", 1).isin(*skip)) if skip else found


def form_actions(page: Column) -> Column:
    """Actions that are neither external nor pages."""
    found = all_of(page, r"(?i)<(?:form|html:form)\s[^>]*action=[\"']([^\"']+)[\"']")
    return F.filter(found, lambda a: ~a.rlike(r"^(?:https?:|mailto:|javascript:)|[.](?:jsp|html?)(?:[?#]|$)"))


def form_fields(page: Column) -> Column:
    return all_of(page, r"(?i)<(?:input|select|textarea)\s[^>]*name=[\"']([^\"']+)[\"']")


def attributes(tag: Column) -> Column:
    """Attribute map of one tag's text; a flag alone has an empty value."""
    found = all_of(F.regexp_replace(tag, r"^<?/?[\w:]+", ""), r"([\w:-]+(?:\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?)", 1)
    pairs = F.transform(found, lambda a: F.struct(F.lower(F.regexp_extract(a, r"^([\w:-]+)", 1)).alias("k"), F.regexp_replace(F.regexp_extract(a, r"=\s*(.*)$", 1), "^[\"']|[\"']$", "").alias("v")))
    return F.map_from_entries(F.array_distinct(pairs))


def attribute_names(html: Column, tag: str) -> Column:
    tags = all_of(html, rf"(?i)<{tag}\s([^>]*)>")
    return F.flatten(F.transform(tags, lambda t: F.regexp_extract_all(t, F.lit(r"([a-zA-Z:-]+)="), F.lit(1))))


def comments(html: Column) -> Column:
    return all_of(html, r"(?s)<!--(.*?)-->")


def script_blocks(html: Column) -> Column:
    return all_of(html, r"(?is)<script[^>]*>(.*?)</script>")


def style_blocks(html: Column) -> Column:
    return all_of(html, r"(?is)<style[^>]*>(.*?)</style>")


def js_functions(text: Column) -> Column:
    forms = (r"\bfunction\s+(\w+)\s*\(", r"\b(?:var|let|const)\s+(\w+)\s*=\s*function\b", r"\b(?:var|let|const)\s+(\w+)\s*=\s*\([^)]*\)\s*=>", r"\b(\w+)\s*:\s*function\b")
    return F.array_sort(F.array_distinct(F.concat(*(all_of(text, f) for f in forms))))


def css_selectors(css: Column) -> dict[str, Column]:
    forms = {"classes": r"\.([a-zA-Z][\w-]*)\s*\{", "ids": r"#([a-zA-Z][\w-]*)\s*\{", "elements": r"(?:^|[\s},])([a-z][a-z0-9]*)\s*\{", "pseudo": r":([a-z-]+)\s*\{", "media": r"@media\s+([^{]+)\{"}
    return {k: F.array_sort(F.array_distinct(all_of(css, p))) for k, p in forms.items()}


def role_tokens(page: Column) -> Column:
    return F.array_sort(F.array_distinct(F.concat(all_of(page, r"(?:isUserInRole|hasRole|hasAuthority)\(\s*['\"]([^'\"]+)['\"]"), all_of(page, r"(?i)<\w+:\w+\s[^>]*roles?=[\"']([^\"']+)[\"']"))))


def properties(text: Column) -> Column:
    """key = value lines, comments left out."""
    lines = F.filter(F.transform(F.split(text, r"\r?\n"), lambda x: F.trim(x)), lambda x: ~x.rlike("^[#!]") & F.contains(x, F.lit("=")))
    return F.transform(lines, lambda x: F.struct(F.trim(F.substring_index(x, "=", 1)).alias("key"), F.trim(F.substr(x, F.instr(x, "=") + 1)).alias("value")))


def gradle(text: Column) -> dict[str, Column]:
    return {"plugins": F.concat(all_of(text, r"id\s*\(?\s*['\"]([^'\"]+)['\"]"), all_of(text, r"apply\s+plugin:\s*['\"]([^'\"]+)['\"]")), "dependencies": all_of(text, r"(?:implementation|api|compile|runtimeOnly|testImplementation|testCompile)\s*\(?\s*['\"]([^'\"]+)['\"]")}


def xml_values(xml: Column, path: str) -> Column:
    """XPath by local names: a/b/@c."""
    steps = "/".join(s if s.startswith("@") else f"*[local-name()='{s}']" for s in path.split("/"))
    return F.xpath(xml, F.lit(f"//{steps}" if path.split("/")[-1].startswith("@") else f"//{steps}/text()"))


def web_xml(xml: Column) -> dict[str, Column]:
    names = {"servlet_names": "servlet/servlet-name", "servlet_classes": "servlet/servlet-class", "mapping_names": "servlet-mapping/servlet-name", "mapping_urls": "servlet-mapping/url-pattern", "filters": "filter/filter-name", "error_codes": "error-page/error-code", "error_locations": "error-page/location", "param_names": "context-param/param-name", "param_values": "context-param/param-value", "session_timeout": "session-config/session-timeout"}
    return {k: xml_values(xml, p) for k, p in names.items()}


def action_xml(xml: Column) -> dict[str, Column]:
    names = {"packages": "package/@name", "namespaces": "package/@namespace", "actions": "action/@name", "paths": "action/@path", "classes": "action/@class", "types": "action/@type", "results": "result", "forwards": "forward/@path", "interceptors": "interceptor/@name", "forms": "form-bean/@name"}
    return {k: xml_values(xml, p) for k, p in names.items()}


def tiles_xml(xml: Column) -> dict[str, Column]:
    return {k: xml_values(xml, p) for k, p in {"names": "definition/@name", "paths": "definition/@path", "templates": "definition/@template", "extends": "definition/@extends", "puts": "put/@name", "values": "put/@value"}.items()}


def beans_xml(xml: Column) -> dict[str, Column]:
    return {k: xml_values(xml, p) for k, p in {"ids": "bean/@id", "classes": "bean/@class", "scans": "component-scan/@base-package", "imports": "import/@resource"}.items()}


def pom_xml(xml: Column) -> dict[str, Column]:
    return {k: xml_values(xml, p) for k, p in {"group": "project/groupId", "artifact": "project/artifactId", "version": "project/version", "dependency_groups": "dependency/groupId", "dependency_artifacts": "dependency/artifactId", "plugins": "plugin/artifactId"}.items()}


def validation_xml(xml: Column) -> dict[str, Column]:
    return {k: xml_values(xml, p) for k, p in {"forms": "form/@name", "fields": "field/@property", "depends": "field/@depends", "variables": "var/var-name", "values": "var/var-value", "messages": "msg/@key", "validators": "validator/@name", "methods": "validator/@method"}.items()}


def service_xml(xml: Column) -> dict[str, Column]:
    return {k: xml_values(xml, p) for k, p in {"codes": "mbean/@code", "names": "mbean/@name", "depends": "mbean/depends", "attributes": "mbean/attribute/@name"}.items()}


def ant_xml(xml: Column) -> dict[str, Column]:
    return {k: xml_values(xml, p) for k, p in {"project": "project/@name", "targets": "target/@name", "property_names": "property/@name", "property_values": "property/@value", "classpath": "pathelement/@location", "filesets": "fileset/@dir"}.items()}


CONFIG_KINDS = (("web_xml", r"(?i)web[.]xml$"), ("struts", r"(?i)struts[^/]*[.]xml$"), ("tiles", r"(?i)tiles[^/]*[.]xml$"), ("validator_rules", r"(?i)validator-rules[.]xml$"), ("validation", r"(?i)validation[^/]*[.]xml$"), ("maven", r"(?i)pom[.]xml$"), ("jboss", r"(?i)jboss[^/]*[.]xml$"), ("ant", r"(?i)build[^/]*[.]xml$"), ("spring", r"(?i)(?:applicationContext|spring)[^/]*[.]xml$"), ("persistence", r"(?i)persistence[.]xml$"), ("gradle", r"(?i)[.]gradle(?:[.]kts)?$"), ("properties", r"(?i)[.]properties$"), ("yaml", r"(?i)[.]ya?ml$"), ("xml", r"(?i)[.]xml$"))


def config_kind(path: Column) -> Column:
    return F.coalesce(*(F.when(path.rlike(p), F.lit(k)) for k, p in CONFIG_KINDS), F.lit("unknown"))


def java_type(code: Column) -> dict[str, Column]:
    """Facts of a source file that patterns can tell."""
    return {
        "package": F.regexp_extract(code, r"(?m)^\s*package\s+([\w.]+)\s*;", 1),
        "imports": all_of(code, r"(?m)^\s*import\s+(?:static\s+)?([\w.*]+)\s*;"),
        "types": all_of(code, r"\b(?:class|interface|enum|@interface)\s+(\w+)"),
        "extends": all_of(code, r"\bclass\s+\w+(?:<[^>]*>)?\s+extends\s+([\w.]+)"),
        "implements": F.flatten(F.transform(all_of(code, r"\bimplements\s+([\w.,\s<>]+?)\s*\{"), lambda x: F.split(x, r"\s*,\s*"))),
        "methods": all_of(code, r"(?:public|protected|private)\s+(?:static\s+|final\s+|synchronized\s+|abstract\s+)*[\w<>\[\],.? ]+?\s+(\w+)\s*\("),
        "fields": all_of(code, r"(?m)^\s*(?:public|protected|private)\s+(?:static\s+|final\s+)*[\w<>\[\],.]+\s+(\w+)\s*(?:=|;)"),
        "annotations": F.array_sort(F.array_distinct(all_of(code, r"@(\w+)\b"))),
        "roles": F.flatten(F.transform(all_of(code, r"@RolesAllowed\(\s*\{?([^)}]*)\}?\s*\)"), lambda x: F.regexp_extract_all(x, F.lit(r"\"([^\"]+)\""), F.lit(1)))),
        "rest_paths": all_of(code, r"@Path\(\s*\"([^\"]*)\"\s*\)"),
        "verbs": all_of(code, r"@(GET|POST|PUT|DELETE|PATCH|HEAD|OPTIONS)\b"),
        "static_calls": all_of(code, r"\b([A-Z]\w+[.]\w+)\s*\("),
        "instance_calls": all_of(code, r"\b([a-z]\w+[.]\w+)\s*\("),
        "procedures": all_of(code, r"\{\s*(?:\?\s*=\s*)?call\s+([\w.]+)"),
        "sql": all_of(code, r"(?i)\"((?:SELECT|INSERT|UPDATE|DELETE)\s[^\"]*)\""),
        "tables": all_of(code, r"@Table\([^)]*name\s*=\s*\"([^\"]+)\""),
        "pointcuts": all_of(code, r"execution\(([^)]*\([^)]*\))\)"),
    }


def decision_points(code: Column) -> Column:
    """One, and one for each branch."""
    return F.lit(1) + F.regexp_count(code, F.lit(r"\b(?:if|for|while|case|catch|throw)\b|\?[^:;]*:"))


def design_patterns(code: Column) -> Column:
    rules = (("builder", r"class\s+\w*Builder\b"), ("dao", r"class\s+\w*D[aA][oO]\b"), ("decorator", r"class\s+\w*Decorator\b"), ("factory", r"class\s+\w*Factory\b|\bcreate[A-Z]\w*\("), ("mvc", r"class\s+\w*Controller\b"), ("observer", r"class\s+\w*(?:Observer|Listener)\b"), ("singleton", r"private\s+static\s+\w+\s+instance\b|getInstance\("))
    return F.array_compact(F.array(*(F.when(code.rlike(p), F.lit(n)) for n, p in rules)))
