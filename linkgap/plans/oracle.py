"""Oracle SQL (DuckDB dialect) for every registered query.

The derived graph and every layer above it are restated here in plain SQL
over the driver's tables (views ``customer orders lineitem part pages``),
following the staging/intermediate/mart model definitions directly, so the
Spark plans are checked against an independent formulation. Every layer
is a MATERIALIZED CTE: computed once per statement, and DuckDB's join
planner never pushes a filter into a chain of layers it has no row
estimates for.
"""

from __future__ import annotations

# Fixed values, written out here on purpose and not taken from the package: a
# wrong weight, pattern, target or fixture choice in the code must show as a difference.
TARGETS = [("own", "brand-1.co"), ("brand2", "brand-2.co"), ("brand3", "brand-3.co"), ("brand4", "brand-4.co"),
           ("brand5", "brand-5.co")]
COMP = ["links_brand2", "links_brand3", "links_brand4", "links_brand5"]
NAMES = ["Brand 2", "Brand 3", "Brand 4", "Brand 5"]
W_GAP, W_AUTH, W_PERS = 0.5, 0.3, 0.2
MIN_COMPETITORS = 2
BRAND_BASE = 10000000
LABELS = "['top10', 'academy', 'devdocs', 'dailywire', 'saashub', 'shop', 'toolsnews']"
BOUND = "TIMESTAMP '1998-01-01 00:00:00'"
_CASE = """CASE
      WHEN regexp_matches(s.source_domain, '(top10|best|review|vs|compare|toplist)') THEN 'listicle/review'
      WHEN regexp_matches(s.source_domain, '(learn|course|academy|tutorial|univ|school|edu)')
        OR s.source_domain LIKE '%.edu' THEN 'community/education'
      WHEN regexp_matches(s.source_domain, '(dev|docs|github|stack|engineer|data|analytics)')
        THEN 'dev-tooling/data-content'
      WHEN regexp_matches(s.source_domain, '(news|daily|weekly|times|post|magazine|media)') THEN 'news/media'
      WHEN regexp_matches(s.source_domain, '(directory|list|tools|apps|software|saas)') THEN 'directory'
      ELSE 'other' END"""


def _cust_rev(k: str) -> str:
    return f"('com.' || {LABELS}[({k} % 7) + 1] || '-' || CAST({k} AS VARCHAR))"


def _unrev(x: str) -> str:
    return f"lower(array_to_string(list_reverse(string_split({x}, '.')), '.'))"


_BRAND_N = "CAST(regexp_extract(p_brand, '#([0-9]+)$', 1) AS BIGINT)"
_SUM_COMP = " + ".join(f"c.{f}" for f in COMP)
_SUM_MAXCOMP = " + ".join(f"max({f})" for f in COMP)
_ORDER = "opportunity_score DESC, competitor_count DESC, authority_percentile DESC, source_domain ASC"

_FLAGS = ",\n    ".join(
    f"max(CASE WHEN target_domain = '{d}' THEN 1 ELSE 0 END) AS links_{k}" for k, d in TARGETS)
_TARGET_ROWS = ", ".join(f"('{k}', '{d}', '{'.'.join(reversed(d.split('.')))}')" for k, d in TARGETS)

CTES = f"""
vertices AS MATERIALIZED (
  SELECT c_custkey AS id, {_cust_rev('c_custkey')} AS rev_domain FROM customer
  UNION ALL
  SELECT DISTINCT {BRAND_BASE} + {_BRAND_N} AS id, 'co.brand-' || CAST({_BRAND_N} AS VARCHAR) AS rev_domain
  FROM part
),
broken_vertices AS MATERIALIZED (SELECT * FROM vertices WHERE id % 97 <> 0),
orders_r AS MATERIALIZED (
  SELECT o_orderkey, o_custkey, o_totalprice,
         CASE WHEN o_orderdate < {BOUND} THEN '2026-05' WHEN o_orderdate >= {BOUND} THEN '2026-06' END AS release
  FROM orders
),
edges AS MATERIALIZED (
  SELECT o.release, o.o_custkey AS src, {BRAND_BASE} + CAST(regexp_extract(p.p_brand, '#([0-9]+)$', 1) AS BIGINT) AS dst
  FROM lineitem l JOIN orders_r o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey
  WHERE o.release IS NOT NULL
),
cust_r AS MATERIALIZED (
  SELECT release, o_custkey, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS value, count(*) AS n_orders
  FROM orders_r WHERE release IS NOT NULL AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'MACHINERY')
  GROUP BY release, o_custkey
),
ranks AS MATERIALIZED (
  SELECT release,
         row_number() OVER (PARTITION BY release ORDER BY value DESC, o_custkey) AS hc_pos,
         CAST(value AS DOUBLE) AS hc_val,
         row_number() OVER (PARTITION BY release ORDER BY n_orders DESC, o_custkey) AS pr_pos,
         CAST(n_orders AS DOUBLE) AS pr_val,
         {_cust_rev('o_custkey')} AS rev_domain
  FROM cust_r
),
releases AS MATERIALIZED (SELECT * FROM (VALUES ('2026-05'), ('2026-06')) r(release)),
targets AS MATERIALIZED (SELECT * FROM (VALUES {_TARGET_ROWS}) t(key, domain, rev_domain)),
target_ids AS MATERIALIZED (SELECT v.id, t.domain AS target_domain FROM vertices v JOIN targets t ON v.rev_domain = t.rev_domain),
inbound AS MATERIALIZED (
  SELECT e.release, e.src AS source_id, ti.target_domain FROM edges e JOIN target_ids ti ON e.dst = ti.id
),
sources AS MATERIALIZED (
  SELECT i.release, v.id AS source_id, v.rev_domain
  FROM vertices v JOIN (SELECT DISTINCT release, source_id FROM inbound) i ON v.id = i.source_id
),
src_ranks AS MATERIALIZED (
  SELECT r.release, r.rev_domain, r.hc_pos, r.pr_pos FROM ranks r
  WHERE EXISTS (SELECT 1 FROM sources s WHERE s.release = r.release AND s.rev_domain = r.rev_domain)
),
raw_backlink_edges AS MATERIALIZED (
  SELECT i.release, i.source_id, s.rev_domain AS source_rev_domain, i.target_domain
  FROM inbound i JOIN sources s ON i.release = s.release AND i.source_id = s.source_id
),
raw_domain_ranks AS MATERIALIZED (SELECT release, rev_domain AS source_rev_domain, hc_pos, pr_pos FROM src_ranks),
raw_graph_stats AS MATERIALIZED (SELECT r.release, (SELECT count(*) FROM vertices) AS nodes_total FROM releases r),
stg_backlink_edges AS MATERIALIZED (
  SELECT DISTINCT release, source_domain, target_domain FROM (
    SELECT release, {_unrev('source_rev_domain')} AS source_domain, lower(target_domain) AS target_domain
    FROM raw_backlink_edges) e
  WHERE source_domain <> target_domain
),
stg_domain_ranks AS MATERIALIZED (
  SELECT r.release, {_unrev('r.source_rev_domain')} AS source_domain, r.hc_pos, s.nodes_total,
         1.0 - (r.hc_pos - 1.0) / s.nodes_total AS authority_percentile
  FROM raw_domain_ranks r JOIN raw_graph_stats s USING (release)
),
coverage AS MATERIALIZED (
  SELECT source_domain,
    {_FLAGS},
    count(DISTINCT release) AS releases_seen,
    CAST(count(DISTINCT release) = (SELECT count(DISTINCT release) FROM stg_backlink_edges) AS INTEGER) AS present_in_both
  FROM stg_backlink_edges GROUP BY source_domain
),
authority AS MATERIALIZED (
  SELECT source_domain, max(authority_percentile) AS authority_percentile FROM stg_domain_ranks GROUP BY source_domain
),
overrides AS MATERIALIZED (
  SELECT {_unrev(_cust_rev('c_custkey'))} AS source_domain, lower(c_mktsegment) AS category
  FROM customer WHERE c_mktsegment = 'AUTOMOBILE'
),
actions AS MATERIALIZED (
  SELECT {_unrev(_cust_rev('c_custkey'))} AS source_domain,
         'Contact ' || c_name || ', ' || lower(c_mktsegment) || ' segment.' AS action
  FROM customer
),
scored AS MATERIALIZED (
  SELECT c.source_domain, {", ".join("c." + f for f in COMP)}, c.links_own,
    {_SUM_COMP} AS competitor_count,
    c.present_in_both, c.releases_seen,
    coalesce(a.authority_percentile, 0) AS authority_percentile,
    {W_GAP} * ({_SUM_COMP}) / {float(len(COMP))}
      + {W_AUTH} * coalesce(a.authority_percentile, 0)
      + {W_PERS} * c.present_in_both AS opportunity_score
  FROM coverage c LEFT JOIN authority a USING (source_domain)
),
heuristic AS MATERIALIZED (SELECT s.source_domain, {_CASE} AS category FROM coverage s),
categorized AS MATERIALIZED (
  SELECT s.*, coalesce(o.category, {_CASE}) AS category
  FROM scored s LEFT JOIN overrides o USING (source_domain)
),
mart AS MATERIALIZED (
  SELECT source_domain, {", ".join(COMP)}, links_own, competitor_count, present_in_both, releases_seen,
         authority_percentile, opportunity_score, category
  FROM categorized WHERE links_own = 0 AND competitor_count >= {MIN_COMPETITORS}
),
mart_k AS MATERIALIZED (
  SELECT source_domain, CAST(regexp_extract(source_domain, '-([0-9]+)[.]com$', 1) AS BIGINT) AS k FROM mart
),
dups AS MATERIALIZED (
  SELECT lower({LABELS}[(g.canon_k % 7) + 1] || '-' || CAST(g.canon_k AS VARCHAR) || '.com') AS canonical_domain,
         m.source_domain AS duplicate_domain
  FROM mart_k m JOIN (SELECT k // 10 AS g, min(k) AS canon_k FROM mart_k GROUP BY 1) g
    ON m.k // 10 = g.g
  WHERE m.k <> g.canon_k
),
canon AS MATERIALIZED (
  SELECT m.*, coalesce(d.canonical_domain, m.source_domain) AS canonical_domain
  FROM mart m LEFT JOIN dups d ON m.source_domain = d.duplicate_domain
),
merged AS MATERIALIZED (
  SELECT canonical_domain AS source_domain,
    max(CASE WHEN source_domain = canonical_domain THEN category END) AS category,
    {", ".join(f"max({f}) AS {f}" for f in COMP)},
    {_SUM_MAXCOMP} AS competitor_count,
    max(present_in_both) AS present_in_both,
    max(authority_percentile) AS authority_percentile,
    CASE WHEN count(*) FILTER (WHERE source_domain <> canonical_domain) > 0
      THEN {W_GAP} * ({_SUM_MAXCOMP}) / {float(len(COMP))} + {W_AUTH} * max(authority_percentile)
           + {W_PERS} * max(present_in_both)
      ELSE max(CASE WHEN source_domain = canonical_domain THEN opportunity_score END) END AS opportunity_score,
    count(*) FILTER (WHERE source_domain <> canonical_domain) AS n_merged,
    coalesce(string_agg(source_domain, ', ' ORDER BY {_ORDER}) FILTER (WHERE source_domain <> canonical_domain), '')
      AS merged_from
  FROM canon GROUP BY canonical_domain
),
top AS MATERIALIZED (
  SELECT * FROM (SELECT *, row_number() OVER (ORDER BY {_ORDER}) AS rank FROM merged) x WHERE rank <= 25
)
"""


def _q(body: str) -> str:
    return f"WITH {CTES.strip()}\n{body.strip()}"


def _title(x: str) -> str:
    word = "lambda w: upper(w[1]) || lower(w[2:])"
    return (f"array_to_string(list_transform(string_split({x}, '/'), lambda p: "
            f"array_to_string(list_transform(string_split(p, '-'), {word}), '-')), '/')")


_HOST = "regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)"


def _norm(x: str) -> str:
    return (f"regexp_replace(regexp_replace(lower(regexp_replace({x}, '^\\s+|\\s+$', '', 'g')), "
            f"'[.]+$', ''), '^www[.]', '')")


def _links_to() -> str:
    parts = ", ".join(f"CASE WHEN {f} = 1 THEN '{n}' END" for f, n in zip(COMP, NAMES))
    return f"concat_ws(', ', {parts})"


_DQ = [
    ("raw_edges_release_not_null", "SELECT * FROM raw_backlink_edges WHERE release IS NULL"),
    ("raw_edges_target_not_null", "SELECT * FROM raw_backlink_edges WHERE target_domain IS NULL"),
    ("raw_edges_target_accepted", "SELECT * FROM raw_backlink_edges WHERE target_domain NOT IN (SELECT domain FROM targets)"),
    ("mart_domain_not_null", "SELECT * FROM mart WHERE source_domain IS NULL"),
    ("mart_domain_unique", "SELECT source_domain FROM mart GROUP BY 1 HAVING count(*) > 1"),
    ("mart_own_flag_zero", "SELECT * FROM mart WHERE links_own NOT IN (0)"),
    ("mart_score_not_null", "SELECT * FROM mart WHERE opportunity_score IS NULL"),
    ("mart_competitor_count_range",
     f"SELECT * FROM mart WHERE competitor_count < {MIN_COMPETITORS} OR competitor_count > {len(COMP)}"),
    ("mart_not_empty", "SELECT 1 FROM (SELECT count(*) AS n FROM mart) WHERE n = 0"),
    ("edges_resolved", "SELECT * FROM inbound i WHERE NOT EXISTS (SELECT 1 FROM sources s "
                       "WHERE s.release = i.release AND s.source_id = i.source_id)"),
    ("targets_present", "SELECT r.release, t.domain FROM releases r, targets t "
                        "WHERE t.rev_domain NOT IN (SELECT rev_domain FROM vertices)"),
    ("node_count_known", "SELECT * FROM raw_graph_stats WHERE nodes_total IS NULL"),
    ("stats_not_empty", "SELECT 1 FROM (SELECT count(*) AS n FROM raw_graph_stats) WHERE n = 0"),
    ("overrides_unique", "SELECT source_domain FROM overrides GROUP BY 1 HAVING count(*) > 1"),
    ("actions_unique", "SELECT source_domain FROM actions GROUP BY 1 HAVING count(*) > 1"),
    ("duplicates_in_mart", "SELECT d FROM (SELECT canonical_domain AS d FROM dups UNION SELECT duplicate_domain FROM dups) "
                           "WHERE d NOT IN (SELECT source_domain FROM mart)"),
    ("duplicates_no_chain", "SELECT * FROM dups WHERE canonical_domain IN (SELECT duplicate_domain FROM dups)"),
    ("report_has_n_companies", "SELECT 1 FROM (SELECT count(*) AS n FROM merged) WHERE n < 25"),
    ("top_without_action", "SELECT * FROM top WHERE source_domain NOT IN (SELECT source_domain FROM actions)"),
    ("top_uncurated", "SELECT * FROM top WHERE source_domain NOT IN (SELECT source_domain FROM overrides)"),
]

_BOTH = "SELECT '2026-05' AS release, {cols} FROM {t} UNION ALL SELECT '2026-06' AS release, {cols} FROM {t}"

ORACLE: dict[str, str] = {
    "scan_vertices": _q(_BOTH.format(cols="id, rev_domain", t="vertices")),
    "scan_edges": _q("SELECT release, src, dst FROM edges"),
    "scan_ranks": _q("SELECT release, rev_domain, hc_pos, pr_pos FROM ranks"),
    "graph_stats": _q("""
        SELECT release, 'nodes' AS key, (SELECT count(*) FROM vertices) AS value FROM releases
        UNION ALL
        SELECT r.release, 'arcs' AS key, (SELECT count(*) FROM edges e WHERE e.release = r.release) AS value
        FROM releases r"""),
    "target_ids": _q(_BOTH.format(cols="id, target_domain", t="target_ids")),
    "missing_targets": _q(f"""
        SELECT r.release, b.target_domain FROM releases r,
          (SELECT DISTINCT 'brand-' || CAST({_BRAND_N} AS VARCHAR) || '.co' AS target_domain,
                           'co.brand-' || CAST({_BRAND_N} AS VARCHAR) AS rev_domain FROM part) b
        WHERE b.rev_domain NOT IN (SELECT rev_domain FROM broken_vertices)"""),
    "inbound_edges": _q("SELECT release, source_id, target_domain FROM inbound"),
    "source_domains": _q("SELECT release, source_id, rev_domain FROM sources"),
    "source_ranks": _q("SELECT release, rev_domain, hc_pos, pr_pos FROM src_ranks"),
    "resolve_edges": _q("SELECT release, source_id, source_rev_domain, target_domain FROM raw_backlink_edges"),
    "unresolved_edges": _q("""
        SELECT i.release, i.source_id, i.target_domain FROM inbound i
        WHERE NOT EXISTS (SELECT 1 FROM broken_vertices v WHERE v.id = i.source_id)"""),
    "unresolved_examples": _q("""
        SELECT release, source_id FROM (
          SELECT release, source_id, row_number() OVER (PARTITION BY release ORDER BY source_id) AS n
          FROM (SELECT DISTINCT i.release, i.source_id FROM inbound i
                WHERE NOT EXISTS (SELECT 1 FROM broken_vertices v WHERE v.id = i.source_id))) x
        WHERE n <= 5"""),
    "load_release_counts": _q("""
        SELECT release, 'raw_backlink_edges' AS table_name, count(*) AS row_count FROM raw_backlink_edges GROUP BY 1
        UNION ALL SELECT r.release, 'raw_domain_ranks', (SELECT count(*) FROM raw_domain_ranks d WHERE d.release = r.release)
          FROM releases r
        UNION ALL SELECT release, 'raw_graph_stats', count(*) FROM raw_graph_stats GROUP BY 1"""),
    "release_select": _q("""
        SELECT release, target_domain, count(*) AS edges FROM raw_backlink_edges
        WHERE release = '2026-06' GROUP BY 1, 2"""),
    "staged_edges": _q("SELECT release, source_domain, target_domain FROM stg_backlink_edges"),
    "unreverse_domain": _q(f"SELECT release, source_rev_domain, {_unrev('source_rev_domain')} AS source_domain FROM raw_domain_ranks"),
    "authority_percentile": _q("SELECT release, source_domain, hc_pos, nodes_total, authority_percentile FROM stg_domain_ranks"),
    "domain_authority": _q("SELECT source_domain, authority_percentile FROM authority"),
    "loaded_releases": _q("SELECT count(DISTINCT release) AS n_releases FROM stg_backlink_edges"),
    "competitor_coverage": _q("SELECT * FROM coverage"),
    "releases_seen": _q("SELECT source_domain, releases_seen FROM coverage"),
    "opportunity_score": _q("SELECT * FROM scored"),
    "competitor_count": _q("SELECT source_domain, competitor_count FROM scored"),
    "self_link_filter": _q(f"""
        SELECT release, count(*) AS edges_in,
               count(*) FILTER (WHERE NOT (s <> t)) AS self_or_null,
               count(*) FILTER (WHERE s <> t) AS edges_kept
        FROM (SELECT release, {_unrev('source_rev_domain')} AS s, lower(target_domain) AS t
              FROM raw_backlink_edges) e GROUP BY release"""),
    "keyword_category": _q("SELECT source_domain, category FROM heuristic"),
    "category_override": _q("SELECT source_domain, category FROM categorized"),
    "gap_filter": _q(f"""
        SELECT c.source_domain, c.links_own, {", ".join("c." + f for f in COMP)}, {_SUM_COMP} AS competitor_count
        FROM coverage c WHERE c.links_own = 0 AND {_SUM_COMP} >= {MIN_COMPETITORS}"""),
    "opportunity_mart": _q("SELECT * FROM mart"),
    "ranked_opportunities": _q(f"SELECT *, row_number() OVER (ORDER BY {_ORDER}) AS rank FROM mart"),
    "canonical_domain": _q("SELECT source_domain, canonical_domain FROM canon"),
    "merge_duplicates": _q("SELECT * FROM merged"),
    "top_opportunities": _q("SELECT * FROM top"),
    "report_rows": _q(f"""
        SELECT t.rank, t.source_domain, t.category, {_title('t.category')} AS category_title,
               {_links_to()} AS links_to,
               CASE WHEN t.present_in_both <> 0 THEN 'Yes' ELSE 'No' END AS present_label,
               t.authority_percentile, t.opportunity_score,
               CASE WHEN t.n_merged > 0 THEN a.action || ' Also linked via ' || t.merged_from || '.'
                    ELSE a.action END AS action
        FROM top t JOIN actions a USING (source_domain)"""),
    "category_sections": _q(f"""
        SELECT category, {_title('category')} AS title, n_rows, best_score, best_rank,
               row_number() OVER (ORDER BY best_score DESC, best_rank ASC) AS section_order
        FROM (SELECT category, count(*) AS n_rows, max(opportunity_score) AS best_score, min(rank) AS best_rank
              FROM top GROUP BY category) s"""),
    "report_totals": _q("""
        SELECT (SELECT count(*) FROM mart) AS candidates, (SELECT count(*) FROM merged) AS distinct_companies,
               count(*) AS shown, CAST(coalesce(sum(n_merged), 0) AS BIGINT) AS merged_among_shown FROM top"""),
    "release_nodes": _q("SELECT release, nodes_total, format('{:,}', nodes_total) || ' domains' AS nodes_label FROM raw_graph_stats"),
    "links_to_label": _q(f"SELECT source_domain, {_links_to()} AS links_to FROM mart"),
    "category_title": _q(f"SELECT DISTINCT category, {_title('category')} AS title FROM mart"),
    "display_formats": _q("""
        SELECT source_domain, format('{:,.3f}', authority_percentile) AS authority_fmt,
               format('{:,.3f}', CAST(opportunity_score AS DOUBLE)) AS score_fmt,
               format('{:,.1f}', authority_percentile * 100.0) || '%' AS authority_pct1,
               format('{:,.2f}', CAST(opportunity_score AS DOUBLE)) AS score_num2
        FROM mart"""),
    "uncurated_top": _q("SELECT rank, source_domain FROM top WHERE source_domain NOT IN (SELECT source_domain FROM overrides)"),
    "dq_summary": _q(" UNION ALL ".join(
        f"SELECT '{name}' AS \"check\", (SELECT count(*) FROM ({sql}) x) AS violations" for name, sql in _DQ)),
    "topic_top25": _q(f"""
        SELECT source_domain, category, competitor_count, authority_percentile, opportunity_score
        FROM mart WHERE competitor_count >= {MIN_COMPETITORS} ORDER BY {_ORDER} LIMIT 25"""),
    "opportunities_by_category": _q(f"""
        SELECT category, count(*) AS opportunity_count, avg(opportunity_score) AS avg_opportunity_score
        FROM mart WHERE competitor_count >= {MIN_COMPETITORS} GROUP BY category"""),
    "topic_query": _q(f"""
        SELECT present_in_both, competitor_count, count(*) AS opportunity_count,
               avg(competitor_count) AS avg_competitor_coverage, avg(opportunity_score) AS avg_opportunity_score
        FROM mart WHERE competitor_count >= {MIN_COMPETITORS} GROUP BY 1, 2"""),
    "normalize_domain": f"SELECT page_id, {_HOST} AS host, {_norm(_HOST)} AS domain FROM pages",
    "reverse_domain": (f"SELECT page_id, {_norm(_HOST)} AS domain, "
                       f"array_to_string(list_reverse(string_split({_norm(_HOST)}, '.')), '.') AS rev_domain FROM pages"),
}
