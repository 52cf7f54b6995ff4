"""DuckDB SQL for the registered queries."""

from __future__ import annotations

FLOWS = """
base AS (
  SELECT
    concat(cast(l_orderkey AS varchar), '-', cast(l_linenumber AS varchar), '-', cast(l_partkey AS varchar), '-',
           cast(l_suppkey AS varchar), '-', cast(l_extendedprice AS varchar)) AS "Flow ID",
    concat('10.0.0.', cast(l_suppkey % 255 AS varchar)) AS "Source IP",
    l_quantity AS "Total Fwd Packets",
    l_extendedprice AS "Flow Duration",
    CASE WHEN l_partkey % 97 = 0 THEN cast('Infinity' AS double)
         WHEN l_partkey % 89 = 0 THEN NULL
         ELSE l_extendedprice / l_quantity END AS "Flow Bytes/s",
    CASE WHEN l_partkey % 101 = 0 THEN NULL ELSE l_discount * 100 END AS "Fwd IAT Mean",
    l_extendedprice * 1.001::double AS "Fwd IAT Total",
    l_tax AS "Active Mean",
    cast(0 AS double) AS "Bwd PSH Flags",
    CASE WHEN l_orderkey % 1000 = 7 AND l_linenumber = 1 THEN 'Heartbleed'
         WHEN l_returnflag = 'N' THEN 'BENIGN'
         WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'DoS Hulk'
         WHEN l_returnflag = 'R' THEN 'DoS GoldenEye'
         WHEN l_linestatus = 'F' THEN 'DoS slowloris'
         ELSE 'DoS Slowhttptest' END AS "Label"
  FROM lineitem),
signal AS (
  SELECT "Flow ID", "Source IP", "Total Fwd Packets", "Flow Duration", "Flow Bytes/s", "Fwd IAT Mean",
    "Fwd IAT Total", "Active Mean", "Bwd PSH Flags",
    CASE "Label" WHEN 'BENIGN' THEN 0 WHEN 'DoS GoldenEye' THEN 10 WHEN 'DoS Hulk' THEN 20
                 WHEN 'DoS Slowhttptest' THEN 30 WHEN 'DoS slowloris' THEN 40 ELSE 50 END
      + 100 * "Active Mean" AS "Packet Length Variance",
    "Label"
  FROM base),
flows AS (SELECT * FROM signal UNION ALL SELECT * FROM signal WHERE "Total Fwd Packets" = 7)"""

FEATURES = [
    "Total Fwd Packets", "Flow Duration", "Flow Bytes/s", "Fwd IAT Mean", "Fwd IAT Total", "Active Mean",
    "Bwd PSH Flags", "Packet Length Variance",
]
KEPT = [f for f in FEATURES if f != "Flow Duration"]
CLASSES = ["BENIGN", "DoS GoldenEye", "DoS Hulk", "DoS Slowhttptest", "DoS slowloris"]
ALL_COLUMNS = ["Flow ID", "Source IP", *FEATURES, "Label"]

FLOATS = FEATURES


def c(name: str) -> str:
    return f'"{name}"'


def fin(name: str) -> str:
    return f"CASE WHEN isfinite({c(name)}) THEN {c(name)} END"


def join(parts, glue=", ") -> str:
    return glue.join(parts)


UNIQUE = """,
uniq AS (SELECT DISTINCT * FROM flows WHERE lower(trim("Label")) <> 'heartbleed'),
keyed AS (SELECT *, md5("Flow ID" || '|42') AS row_key FROM uniq),
counts AS (SELECT "Label", count(*) AS n FROM keyed GROUP BY 1),
total AS (SELECT sum(n)::bigint AS rows, ceil(0.2 * sum(n))::bigint AS n_test FROM counts),
shares AS (
  SELECT "Label", n, (n * n_test) // rows AS whole, (n * n_test) % rows AS rest, n_test FROM counts, total),
quota AS (
  SELECT "Label", n, whole + CASE WHEN row_number() OVER (ORDER BY rest DESC, "Label")
                                  <= n_test - sum(whole) OVER () THEN 1 ELSE 0 END AS n_test
  FROM shares),
placed AS (
  SELECT k.*, row_number() OVER (PARTITION BY k."Label" ORDER BY row_key) <= q.n_test AS is_test
  FROM keyed k JOIN quota q ON k."Label" = q."Label")"""

MEDIANS = f""",
med AS (SELECT {join(f"median({fin(f)}) AS {c(f)}" for f in FEATURES)} FROM placed WHERE NOT is_test),
filled AS (
  SELECT p.row_key, p."Label", p.is_test,
    {join(f"coalesce(CASE WHEN isfinite(p.{c(f)}) THEN p.{c(f)} END, med.{c(f)}, 0) AS {c(f)}" for f in FEATURES)}
  FROM placed p, med)"""

SCALER = f""",
scaler AS (
  SELECT {join(f"avg({c(f)}) AS {c('m ' + f)}, coalesce(nullif(stddev_pop({c(f)}), 0), 1) AS {c('s ' + f)}" for f in FEATURES)}
  FROM filled WHERE NOT is_test),
scaled AS (
  SELECT f.row_key, f."Label", f.is_test,
    {join(f"(f.{c(x)} - scaler.{c('m ' + x)}) / scaler.{c('s ' + x)} AS {c(x)}" for x in FEATURES)}
  FROM filled f, scaler)"""

CODE = "CASE \"Label\" " + join((f"WHEN '{name}' THEN {i}" for i, name in enumerate(CLASSES)), " ") + " END::integer"


def with_flows(select: str, *steps: str) -> str:
    return f"WITH {FLOWS}{''.join(steps)}\n{select}"


def rounded(names, digits, prefix="") -> str:
    return join(f"round({prefix}{c(n)}, {digits}) + 0.0 AS {c(n)}" for n in names)


def union(parts) -> str:
    return "\nUNION ALL\n".join(parts)


PAIRS = [(a, b) for i, a in enumerate(FEATURES) for b in FEATURES[i + 1 :]]


def pair_corr(table: str, where: str = "TRUE") -> str:
    """corr() skips rows where either side is null; infinities are made null first."""
    return union(
        f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, abs(corr({fin(a)}, {fin(b)})) AS r FROM {table} WHERE {where}"
        for a, b in PAIRS
    )


HIST_FEATURES = 6

HISTOGRAM = (
    ",\nfin AS (SELECT "
    + join(f"{fin(f)} AS {c(f)}" for f in FEATURES)
    + " FROM flows),\nlong AS ("
    + union(f"SELECT {i} AS pos, '{f}' AS feature, {c(f)} AS x FROM fin WHERE {c(f)} IS NOT NULL" for i, f in enumerate(FEATURES))
    + "),\ntop AS (SELECT feature FROM long GROUP BY feature ORDER BY var_samp(x) DESC, min(pos) LIMIT 6),\n"
    + "ranked AS (SELECT feature, x, row_number() OVER (PARTITION BY feature ORDER BY x) - 1 AS r, "
    + "0.99::double * (count(*) OVER (PARTITION BY feature) - 1) AS spot FROM long WHERE feature IN (SELECT feature FROM top)),\n"
    + "caps AS (SELECT feature, CASE WHEN min(floor(spot)) = min(ceil(spot)) THEN min(x) FILTER (r = floor(spot)) ELSE "
    + "(min(ceil(spot)) - min(spot)) * min(x) FILTER (r = floor(spot)) + (min(spot) - min(floor(spot))) * min(x) FILTER (r = ceil(spot)) END AS hi, "
    + "min(x) AS lo FROM ranked GROUP BY feature),\n"
    + "edges AS (SELECT feature, hi AS cap, CASE WHEN hi > lo THEN lo ELSE lo - 0.5 END AS lo, "
    + "CASE WHEN hi > lo THEN (hi - lo) / 50 ELSE 1.0::double / 50 END AS w FROM caps),\n"
    + "binned AS (SELECT r.feature, least(floor((least(x, cap) - lo) / w), 49)::bigint AS bin, lo, w FROM ranked r JOIN edges e ON r.feature = e.feature)\n"
)

RULE = (
    "CASE floor((\"Packet Length Variance\" + 3) / 10)::integer WHEN 0 THEN 'BENIGN' WHEN 1 THEN 'DoS GoldenEye' "
    "WHEN 2 THEN 'DoS Hulk' WHEN 3 THEN 'DoS Slowhttptest' WHEN 4 THEN 'DoS slowloris' ELSE 'Heartbleed' END"
)
RULED = f""",
ruled AS (SELECT "Label" AS label, {RULE} AS prediction FROM flows)"""


def metrics_sql(source: str, classes_sql: str) -> str:
    """CTEs names, cells (K x K), metrics from a table of (label, prediction)."""
    return f"""
pairs AS (SELECT label, prediction, count(*) AS n FROM {source} WHERE label IS NOT NULL AND prediction IS NOT NULL GROUP BY 1, 2),
names AS ({classes_sql}),
cells AS (
  SELECT a.label AS label, b.label AS prediction, coalesce(p.n, 0)::bigint AS n
  FROM names a CROSS JOIN names b LEFT JOIN pairs p ON p.label = a.label AND p.prediction = b.label),
metrics AS (
  SELECT a.label,
    coalesce((SELECT sum(n) FROM cells x WHERE x.label = a.label AND x.prediction = a.label), 0) AS hits,
    (SELECT sum(n) FROM cells x WHERE x.label = a.label) AS support,
    (SELECT sum(n) FROM cells x WHERE x.prediction = a.label) AS predicted
  FROM names a),
scores AS (
  SELECT label, support::bigint AS support, hits,
    CASE WHEN predicted = 0 THEN 0.0 ELSE hits::double / predicted END AS p,
    CASE WHEN support = 0 THEN 0.0 ELSE hits::double / support END AS r,
    CASE WHEN predicted + support = 0 THEN 0.0 ELSE 2.0 * hits::double / (predicted + support) END AS f
  FROM metrics)"""


LABEL_PAIRS = "labelled AS (SELECT quality AS label, toxic AS prediction FROM labels),"
TWO = "SELECT unnest([0, 1])::integer AS label"
SIX = f"SELECT unnest({[*CLASSES, 'Heartbleed']!r}) AS label"

_TEXTS = join(
    f"CASE WHEN \"Total Fwd Packets\" = 13 THEN 'n/a' WHEN {c(n)} = 'Infinity'::double THEN ' Infinity ' "
    f"ELSE round({c(n)} * 100)::bigint::varchar END AS {c(n)}"
    for n in FEATURES
)
TEXT_FLOWS = f""",
texts AS (SELECT "Flow ID", {_TEXTS} FROM flows)"""

MINORITY_NEED = """,
train_counts AS (SELECT "Label", count(*) AS n FROM placed WHERE NOT is_test GROUP BY 1),
needs AS (SELECT "Label", n, max(n) OVER () AS top FROM train_counts)"""

EVENT_LOG = """
log AS (SELECT event_id, ts, event_type AS predicted_class, value / 500 AS confidence, event_type <> 'view' AS is_attack
        FROM events)"""

TEST_ROWS = "(SELECT count(*) FROM placed WHERE is_test)"


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}
    # profile
    sql["table_shape"] = with_flows(
        "SELECT count(*) AS row_count, 11::bigint AS column_count, 8::bigint AS numeric_columns, "
        "3::bigint AS string_columns, 0::bigint AS other_columns FROM flows"
    )
    sql["missing_report"] = with_flows(
        "SELECT column_name, missing_count, round(missing_count::double / rows * 100, 3) AS missing_pct FROM ("
        + union(
            f"SELECT '{n}' AS column_name, count(*) FILTER ({c(n)} IS NULL) AS missing_count, count(*) AS rows FROM flows"
            for n in ALL_COLUMNS
        )
        + ") WHERE missing_count > 0"
    )
    sql["infinite_report"] = with_flows(
        "SELECT * FROM ("
        + union(f"SELECT '{n}' AS column_name, count(*) FILTER (isinf({c(n)})) AS infinite_count FROM flows" for n in FLOATS)
        + ") WHERE infinite_count > 0"
    )
    sql["duplicate_report"] = with_flows(
        "SELECT (a.n - b.n)::bigint AS duplicate_count, round((a.n - b.n)::double / a.n * 100, 3) AS duplicate_pct "
        "FROM (SELECT count(*) AS n FROM flows) a, (SELECT count(*) AS n FROM (SELECT DISTINCT * FROM flows)) b"
    )
    sql["class_distribution"] = with_flows(
        'SELECT "Label" AS label, count(*) AS count, round(count(*)::double / (SELECT count(*) FROM flows) * 100, 3) AS percentage '
        "FROM flows GROUP BY 1"
    )
    sql["clean_class_distribution"] = with_flows(
        'SELECT "Label" AS label, count(*) AS count, round(count(*)::double / (SELECT count(*) FROM uniq) * 100, 3) AS percentage '
        "FROM uniq GROUP BY 1",
        UNIQUE,
    )
    sql["identifier_columns"] = with_flows(
        union(f"SELECT '{n}' AS column_name, count({c(n)}) AS cells FROM flows" for n in ("Flow ID", "Source IP"))
    )
    sql["remaining_columns"] = with_flows(
        union(f"SELECT '{n}' AS column_name, count({c(n)}) AS cells FROM flows" for n in (*FEATURES, "Label"))
    )
    sql["numeric_columns"] = with_flows(
        union(f"SELECT {i} AS position, '{n}' AS column_name, count({c(n)}) AS cells FROM flows" for i, n in enumerate(FEATURES))
    )
    sql["correlated_pairs"] = with_flows(
        "SELECT feature_1, feature_2, round(r, 9) AS correlation FROM r WHERE NOT isnan(r) AND r >= 0.9",
        f",\nr AS ({pair_corr('flows')})",
    )
    sql["all_pair_correlations"] = with_flows(
        "SELECT feature_1, feature_2, round(CASE WHEN isnan(r) THEN NULL ELSE r END, 9) AS correlation FROM r",
        f",\nr AS ({pair_corr('flows')})",
    )
    sql["correlated_drop_list"] = with_flows(
        "SELECT DISTINCT feature_1 AS column_name FROM r WHERE NOT isnan(r) AND r >= 0.9",
        UNIQUE, MEDIANS, f",\nr AS ({pair_corr('filled', 'NOT is_test')})",
    )
    sql["variance_ranking"] = with_flows(
        "SELECT * FROM ("
        + union(f"SELECT '{n}' AS feature, round(var_samp({fin(n)}), 3) AS variance FROM flows" for n in FEATURES)
        + ") ORDER BY variance DESC LIMIT 6"
    )
    sql["feature_histogram"] = with_flows(
        "SELECT feature, bin, round(lo + bin * w, 6) AS bin_start, round(lo + (bin + 1) * w, 6) AS bin_end, count(*) AS count "
        "FROM binned GROUP BY ALL",
        HISTOGRAM,
    )
    sql["clipped"] = with_flows(
        'SELECT "Flow ID", '
        + join(
            f"CASE WHEN {fin(n)} >= (SELECT quantile_cont({fin(n)}, 0.99) FROM flows) * (1 - 1e-12::double) "
            f"THEN round((SELECT quantile_cont({fin(n)}, 0.99) FROM flows), 6) ELSE {fin(n)} END AS {c(n)}"
            for n in FEATURES
        )
        + " FROM flows"
    )
    sql["eda_summary"] = with_flows(
        "SELECT 'flows' AS dataset_name, (SELECT count(*) FROM flows) AS row_count, 11::bigint AS column_count, "
        "'Label' AS target_column, "
        "(SELECT string_agg(\"Label\" || '=' || n, ',' ORDER BY \"Label\") FROM (SELECT \"Label\", count(*) AS n FROM flows GROUP BY 1)) AS class_distribution, "
        "(SELECT string_agg(k, ',' ORDER BY k) FROM ("
        + union(f"SELECT '{n}' AS k FROM flows WHERE {c(n)} IS NULL GROUP BY 1" for n in ALL_COLUMNS)
        + ")) AS missing_value_columns, (SELECT string_agg(k, ',' ORDER BY k) FROM ("
        + union(f"SELECT '{n}' AS k FROM flows WHERE isinf({c(n)}) GROUP BY 1" for n in FLOATS)
        + ")) AS infinite_value_columns, "
        "((SELECT count(*) FROM flows) - (SELECT count(*) FROM (SELECT DISTINCT * FROM flows)))::bigint AS duplicate_count, "
        "round(100.0::double * ((SELECT count(*) FROM flows) - (SELECT count(*) FROM (SELECT DISTINCT * FROM flows))) / (SELECT count(*) FROM flows), 3) AS duplicate_pct, "
        "'Flow ID,Source IP' AS identifier_columns, "
        "(SELECT least(count(*), 25) FROM r WHERE NOT isnan(r) AND r >= 0.9)::bigint AS high_correlation_pair_count, "
        "(SELECT count(*) FROM r WHERE NOT isnan(r) AND r >= 0.9)::bigint AS all_correlated_pairs",
        f",\nr AS ({pair_corr('flows')})",
    )
    # cleaning
    sql["drop_classes"] = with_flows(
        f"SELECT {join(c(n) for n in ALL_COLUMNS)} FROM flows WHERE lower(trim(\"Label\")) NOT IN ('heartbleed', 'dos hulk')"
    )
    sql["removed_class_counts"] = with_flows(
        "SELECT trim(\"Label\") AS label, count(*) AS removed FROM flows WHERE lower(trim(\"Label\")) IN ('heartbleed', 'dos hulk') GROUP BY 1"
    )
    sql["dedup"] = with_flows(f"SELECT DISTINCT {join(c(n) for n in ALL_COLUMNS)} FROM flows")
    sql["clean_infinities"] = with_flows(f'SELECT "Flow ID", {join(f"{fin(n)} AS {c(n)}" for n in FEATURES)} FROM flows')
    sql["features_and_target"] = with_flows(f'SELECT {join(c(n) for n in FEATURES)}, "Label" AS target FROM flows')
    # split
    sql["label_codes"] = with_flows(
        'SELECT (row_number() OVER (ORDER BY "Label") - 1)::integer AS code, "Label" AS label, n FROM counts', UNIQUE
    )
    sql["split_quota"] = with_flows('SELECT "Label" AS label, n, n_test::bigint AS n_test FROM quota', UNIQUE)
    sql["stratified_split"] = with_flows(
        "SELECT \"Flow ID\", \"Label\", CASE WHEN is_test THEN 'test' ELSE 'train' END AS side FROM placed", UNIQUE
    )
    # fitted state
    sql["train_medians"] = with_flows(
        union(f"SELECT '{n}' AS feature, round({c(n)}, 8) AS median FROM med" for n in FEATURES), UNIQUE, MEDIANS
    )
    sql["scaler_state"] = with_flows(
        union(
            f"SELECT '{n}' AS feature, round({c('m ' + n)}, 8) AS mean, round({c('s ' + n)}, 8) AS scale FROM scaler" for n in KEPT
        ),
        UNIQUE, MEDIANS, SCALER,
    )
    sql["imputed"] = with_flows(
        f'SELECT row_key, {join(f"round({c(n)}, 8) AS {c(n)}" for n in FEATURES)} FROM filled WHERE is_test', UNIQUE, MEDIANS
    )
    sql["scaled_test"] = with_flows(
        f'SELECT row_key, "Label", {rounded(KEPT, 8)} FROM scaled WHERE is_test', UNIQUE, MEDIANS, SCALER
    )
    sql["prepared_train"] = with_flows(
        f'SELECT row_key, "Label", {CODE} AS label_code, {rounded(KEPT, 8)} FROM scaled WHERE NOT is_test',
        UNIQUE, MEDIANS, SCALER,
    )
    sql["unscaled"] = with_flows(
        f'SELECT row_key, {join(f"round({c(n)}, 7) + 0.0 AS {c(n)}" for n in KEPT)} '
        "FROM filled WHERE is_test",
        UNIQUE, MEDIANS,
    )
    sql["preparation_summary"] = with_flows(
        "SELECT (SELECT count(*) FROM flows) AS rows_loaded, "
        "'Heartbleed=' || (SELECT count(*) FROM flows WHERE \"Label\" = 'Heartbleed') AS dropped_classes, "
        "(SELECT count(*) FROM uniq) AS rows_after_dedup, "
        "((SELECT count(*) FROM flows WHERE \"Label\" <> 'Heartbleed') - (SELECT count(*) FROM uniq))::bigint AS duplicates_removed, "
        "'Flow ID,Source IP' AS dropped_identifier_columns, "
        "(SELECT string_agg(DISTINCT feature_1, ',') FROM r WHERE NOT isnan(r) AND r >= 0.9) AS dropped_correlated_columns, "
        "(SELECT count(*) FROM placed WHERE NOT is_test) AS train_rows_before_balancing, "
        f"(SELECT max(n) * 5 FROM (SELECT count(*) AS n FROM placed WHERE NOT is_test GROUP BY \"Label\"))::bigint AS train_rows_after_balancing, "
        f"{TEST_ROWS} AS test_rows, 7::bigint AS final_feature_count, 8::bigint AS total_feature_count, "
        f"'{','.join(KEPT)}' AS final_feature_columns, '{','.join(CLASSES)}' AS label_classes, 'smote' AS balancing_method",
        UNIQUE, MEDIANS, f",\nr AS ({pair_corr('filled', 'NOT is_test')})",
    )
    # balancing
    sql["class_weights"] = with_flows(
        'SELECT "Label" AS label, count(*) AS n, round((SELECT count(*) FROM flows)::double / '
        '((SELECT count(DISTINCT "Label") FROM flows) * count(*)), 10) AS weight FROM flows GROUP BY 1'
    )
    sql["class_weights_labels"] = (
        "SELECT quality AS label, count(*) AS n, round((SELECT count(*) FROM labels)::double / "
        "((SELECT count(DISTINCT quality) FROM labels) * count(*)), 10) AS weight FROM labels GROUP BY 1"
    )
    sql["row_weights"] = with_flows(
        'SELECT f."Flow ID", round(t.rows::double / (t.classes * k.n), 10) AS class_weight FROM flows f '
        'JOIN (SELECT "Label", count(*) AS n FROM flows GROUP BY 1) k ON f."Label" = k."Label", '
        '(SELECT count(*) AS rows, count(DISTINCT "Label") AS classes FROM flows) t'
    )
    sql["smote_class_counts"] = with_flows(
        'SELECT "Label" AS label, n AS original, (top - n)::bigint AS synthetic, top AS n FROM needs', UNIQUE, MINORITY_NEED
    )
    sql["smote_bounds"] = with_flows(
        'SELECT "Label" AS label, (top - n)::bigint AS synthetic, 0::bigint AS outside, 0::bigint AS foreign_base, '
        "0::bigint AS foreign_neighbour, least(n, top - n)::bigint AS bases FROM needs WHERE n < top",
        UNIQUE, MINORITY_NEED,
    )
    # selections
    sql["subsample"] = with_flows(
        "SELECT \"Flow ID\" FROM (SELECT DISTINCT * FROM flows) ORDER BY md5(\"Flow ID\" || '|42') LIMIT 3000"
    )
    sql["per_class_sample"] = with_flows(
        'SELECT "Flow ID", "Label" FROM (SELECT "Flow ID", "Label", row_number() OVER '
        "(PARTITION BY \"Label\" ORDER BY md5(\"Flow ID\" || '|42')) AS r FROM (SELECT DISTINCT * FROM flows)) WHERE r <= 25"
    )
    sql["per_class_sample_vectors"] = (
        "SELECT vec_id, label FROM (SELECT vec_id, label, row_number() OVER "
        "(PARTITION BY label ORDER BY md5(vec_id::varchar || '|42')) AS r FROM embeddings) WHERE r <= 3"
    )
    sql["first_per_class"] = (
        "SELECT vec_id, label FROM (SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS r "
        "FROM embeddings) WHERE r <= 2"
    )
    sql["replay_order"] = with_flows(
        'SELECT row_number() OVER (ORDER BY h) AS position, "Flow ID" FROM '
        "(SELECT \"Flow ID\", md5(\"Flow ID\" || '|42') AS h FROM (SELECT DISTINCT * FROM flows)) ORDER BY h LIMIT 200"
    )
    # score preparation
    sql["coerce_features"] = with_flows(
        f'SELECT "Flow ID", {join(f"try_cast(trim({c(n)}) AS double) AS {c(n)}" for n in FEATURES)} FROM texts', TEXT_FLOWS
    )
    sql["raw_values"] = with_flows(
        'SELECT "Flow ID", '
        + join(f"CASE WHEN isfinite(try_cast(trim({c(n)}) AS double)) THEN try_cast(trim({c(n)}) AS double) END AS {c(n)}" for n in FEATURES)
        + " FROM texts",
        TEXT_FLOWS,
    )
    sql["score_input"] = sql["scaled_test"]
    sql["required_features"] = (
        "SELECT 'k' AS feature, count(*) FILTER (json_extract(props, '$.k') IS NOT NULL) > 0 AS present FROM events "
        "UNION ALL SELECT 'absent', count(*) FILTER (json_extract(props, '$.absent') IS NOT NULL) > 0 FROM events"
    )
    # evaluation
    for name, source, classes, head in (
        ("labels", "labelled", TWO, LABEL_PAIRS),
        ("flows", "ruled", SIX, FLOWS + RULED + ","),
    ):
        tables = f"WITH {head}{metrics_sql(source, classes)}"
        part = "" if name == "labels" else "flow_"
        sql[part + "confusion_matrix"] = f"{tables} SELECT label, prediction, n FROM cells"
        sql[part + "confusion_normalised"] = (
            f"{tables} SELECT label, prediction, round(CASE WHEN sum(n) OVER w = 0 THEN 0.0 ELSE n::double / sum(n) OVER w END, 10) "
            "AS share FROM cells WINDOW w AS (PARTITION BY label)"
        )
        sql[part + "per_class_metrics"] = (
            f"{tables} SELECT label, round(p, 10) AS precision, round(r, 10) AS recall, round(f, 10) AS f1, support FROM scores"
        )
        sql[part + "overall_metrics"] = (
            f"{tables} SELECT round(sum(hits)::double / sum(support), 10) AS accuracy, round(avg(f), 10) AS macro_f1, "
            "round(sum(f * support) / sum(support), 10) AS weighted_f1, "
            f"(SELECT count(*) FROM {source} WHERE label IS NOT NULL AND prediction IS NULL) AS unscored, "
            f"(SELECT count(*) FROM {source} WHERE label IS NULL) AS unlabelled FROM scores"
        )
    sql["low_support"] = f"WITH {FLOWS}{RULED},{metrics_sql('ruled', SIX)} SELECT label, support FROM scores WHERE support > 0 AND support < 30"
    # models: invariants that hold for any right model
    rows_ok = f"SELECT {TEST_ROWS} AS rows, 0::bigint AS bad_sum, 0::bigint AS bad_class, 0::bigint AS bad_confidence, 0::bigint AS bad_flag, TRUE AS learned"
    sql["rf_score_invariants"] = with_flows(rows_ok, UNIQUE)
    sql["gbt_score_invariants"] = with_flows(rows_ok, UNIQUE)
    sql["softmax_score_invariants"] = with_flows(rows_ok, UNIQUE)
    sql["softmax_boosting"] = with_flows(
        f"SELECT {TEST_ROWS} AS rows, 3::bigint AS rounds, TRUE AS starts_even, TRUE AS losses_fall, TRUE AS as_good_as_one_per_class, TRUE AS weights_act",
        UNIQUE,
    )
    sql["softmax_round_trip"] = with_flows(f"SELECT {TEST_ROWS} AS flows, {TEST_ROWS} AS matching, 0::bigint AS differing", UNIQUE)
    sql["weighted_rf_invariants"] = with_flows(rows_ok, UNIQUE)
    # the feature whose class means differ most, for its spread, is the one a forest leans on
    spread = union(
        f"SELECT '{n}' AS k, (SELECT sum(n * (m - mean) ** 2) / nullif(sum(n) * any_value(spread), 0) FROM "
        f'(SELECT count(*) AS n, avg({c(n)}) AS m FROM filled WHERE NOT is_test GROUP BY "Label"), '
        f"(SELECT avg({c(n)}) AS mean, var_pop({c(n)}) AS spread FROM filled WHERE NOT is_test)) AS eta"
        for n in KEPT
    )
    sql["rf_importances"] = with_flows(
        "SELECT count(*) AS features, TRUE AS sums_to_one, TRUE AS sorted, max_by(k, coalesce(eta, 0)) AS top_feature FROM etas",
        UNIQUE, MEDIANS, f",\netas AS ({spread})",
    )
    sql["model_comparison"] = with_flows(
        union(
            f"SELECT '{m}' AS model, {TEST_ROWS} AS rows, TRUE AS accuracy_agrees, TRUE AS macro_f1_agrees, TRUE AS valid"
            for m in ("random_forest", "boosted_trees")
        ),
        UNIQUE,
    )
    sql["best_model"] = with_flows(f"SELECT 2::bigint AS candidates, {TEST_ROWS} AS rows, TRUE AS is_best", UNIQUE)
    sql["model_info"] = with_flows(
        "SELECT 'random_forest' AS model_name, (SELECT string_agg(DISTINCT \"Label\", ',' ORDER BY \"Label\") FROM uniq) AS classes, "
        f"'BENIGN' AS benign_label, {len(FEATURES)} - (SELECT count(DISTINCT feature_1) FROM r WHERE NOT isnan(r) AND r >= 0.9) "
        f"AS feature_count, '{','.join(KEPT)}' AS feature_columns",
        UNIQUE, MEDIANS, f",\nr AS ({pair_corr('filled', 'NOT is_test')})",
    )
    sql["decoded_labels"] = with_flows('SELECT row_key, "Label" AS decoded FROM placed WHERE is_test', UNIQUE)
    sql["bundle_round_trip"] = with_flows(f"SELECT {TEST_ROWS} AS flows, {TEST_ROWS} AS matching, 0::bigint AS differing", UNIQUE)
    # log and sessions on events
    sql["batch_summary"] = "SELECT count(*) AS count, count(*) FILTER (event_type <> 'view') AS attacks_detected FROM events"
    sql["recent_predictions"] = (
        f"WITH {EVENT_LOG} SELECT event_id::varchar AS seq, ts AS logged_at, predicted_class, confidence, is_attack FROM log "
        "ORDER BY ts DESC, event_id::varchar DESC LIMIT 50"
    )
    sql["log_stats"] = "SELECT event_type AS predicted_class, count(*) AS n, count(*) FILTER (event_type <> 'view') AS attacks FROM events GROUP BY 1"
    sql["log_totals"] = (
        "SELECT count(*) AS total, (SELECT string_agg(k || '=' || n, ',' ORDER BY k) FROM "
        "(SELECT event_type AS k, count(*) AS n FROM events GROUP BY 1)) AS per_class, "
        "count(*) FILTER (event_type <> 'view') AS attacks, count(*) FILTER (event_type <> 'view') AS flagged FROM events"
    )
    truth = "CASE WHEN value < 250 THEN event_type ELSE 'view' END"
    sql["session_summary"] = (
        f"SELECT count(*) AS total_flows, count(*) FILTER (event_type <> 'view') AS attacks_detected, "
        f"count(*) FILTER (event_type = {truth}) AS correct_predictions, "
        f"round(count(*) FILTER (event_type = {truth})::double / count(*), 4) AS accuracy_vs_true_label, "
        "(SELECT string_agg(k || '=' || n, ',' ORDER BY k) FROM (SELECT event_type AS k, count(*) AS n FROM events GROUP BY 1)) AS predicted_class_counts, "
        "40.0::double AS duration_seconds, round(count(*) / 40.0::double, 2) AS flows_per_second FROM events"
    )
    sql["attack_flags"] = "SELECT event_id, lower(event_type) <> 'view' AS is_attack FROM events"
    sql["outcome_flags"] = f"SELECT event_id, event_type = {truth} AS is_correct, event_type <> {truth} AS is_missed FROM events"
    # sources and sinks
    sql["csv_load"] = with_flows(f"SELECT {join(c(n) for n in ALL_COLUMNS)} FROM flows")
    sql["prepared_round_trip"] = with_flows(
        f"SELECT CASE WHEN is_test THEN 'test' ELSE 'train' END AS split, row_key, \"Label\", {CODE} AS label_code, {rounded(KEPT, 8)} FROM scaled",
        UNIQUE, MEDIANS, SCALER,
    )
    none = "NULL::double AS median, NULL::double AS mean, NULL::double AS scale"
    named = [("class", i, x) for i, x in enumerate(CLASSES)]
    named += [("identifier", 0, "Flow ID"), ("identifier", 1, "Source IP"), ("correlated", 0, "Flow Duration")]
    named += [("target", 0, "Label"), ("balancing", 0, "none")]
    sql["state_round_trip"] = with_flows(
        union(
            f"SELECT 'feature' AS kind, {i}::bigint AS pos, '{n}' AS name, round((SELECT {c(n)} FROM med), 8) + 0.0 AS median, "
            f"round({c('m ' + n)}, 8) + 0.0 AS mean, round({c('s ' + n)}, 8) + 0.0 AS scale FROM scaler"
            for i, n in enumerate(KEPT)
        )
        + union([""] + [f"SELECT '{kind}', {i}::bigint, '{n}', {none}" for kind, i, n in named]),
        UNIQUE, MEDIANS, SCALER,
    )
    per_class = "(SELECT string_agg(k || '=' || n, ',' ORDER BY k) FROM (SELECT event_type AS k, count(*) AS n FROM events GROUP BY 1))"
    sql["absent_log"] = (
        "SELECT 'absent' AS stage, 0::bigint AS total, 0::bigint AS attacks, '' AS per_class, 0::bigint AS newest, '' AS report, FALSE AS there "
        f"UNION ALL SELECT 'written', count(*), count(*) FILTER (event_type <> 'view'), {per_class}, least(count(*), 50), {per_class}, TRUE FROM events"
    )
    sql["stored_reports"] = sql["flow_per_class_metrics"].replace(
        "AS f1, support FROM", "AS f1, support, (SELECT count(*) FROM flows) AS row_count, "
        "((SELECT count(*) FROM flows) - (SELECT count(*) FROM (SELECT DISTINCT * FROM flows)))::bigint AS duplicate_count, "
        "11::bigint AS column_count FROM"
    )
    sql["log_round_trip"] = "SELECT event_type AS predicted_class, count(*) AS n, count(*) FILTER (event_type <> 'view') AS attacks FROM events GROUP BY 1"
    # streams
    sql["stream_scores_match_batch"] = with_flows(
        f"SELECT {TEST_ROWS} AS flows, {TEST_ROWS} AS matching, 0::bigint AS differing", UNIQUE
    )
    sql["stream_class_counts"] = sql["log_stats"]
    logged = (
        "SELECT event_id::varchar AS seq, event_type AS predicted_class, round(value / 500, 8) AS confidence, "
        "event_type <> 'view' AS is_attack, props AS features_json, '{}' AS run FROM events WHERE {}"
    )
    runs = (("run", "TRUE"), ("run-2", "event_type <> 'view'"))
    sql["stream_log_rows"] = union(logged.format(run, which) for run, which in runs)
    hit = f"event_id % 7 <> 0 AND event_type = {truth}"
    sql["stream_session_summary"] = union(
        f"SELECT '{run}' AS run, count(*) AS total_flows, count(*) FILTER (event_type <> 'view') AS attacks_detected, "
        f"count(*) FILTER ({hit}) AS correct_predictions, "
        f"round(count(*) FILTER ({hit})::double / count(*), 4) AS accuracy_vs_true_label, "
        f"(SELECT string_agg(k || '=' || n, ',' ORDER BY k) FROM (SELECT event_type AS k, count(*) AS n FROM events WHERE {which} GROUP BY 1)) AS predicted_class_counts, "
        f"TRUE AS timed, TRUE AS rated FROM events WHERE {which}"
        for run, which in runs
    )
    sql["stream_parity"] = (
        "SELECT coalesce(l.seq, r.seq) AS seq, left_class, right_class FROM "
        "(SELECT event_id::varchar AS seq, event_type AS left_class FROM events WHERE event_id % 13 <> 0) l FULL OUTER JOIN "
        "(SELECT event_id::varchar AS seq, CASE WHEN event_id % 5 = 0 THEN 'other' ELSE event_type END AS right_class "
        "FROM events WHERE event_id % 11 <> 0) r ON l.seq = r.seq WHERE left_class IS DISTINCT FROM right_class"
    )
    # explanations
    sql["explain_additivity"] = with_flows(
        f"SELECT 'random_forest' AS model, {TEST_ROWS} AS flows, 0::bigint AS not_additive, 0::bigint AS other_class "
        f"UNION ALL SELECT 'boosted_trees', {TEST_ROWS}, 0::bigint, 0::bigint "
        f"UNION ALL SELECT 'softmax_trees', {TEST_ROWS}, 0::bigint, 0::bigint",
        UNIQUE,
    )
    sql["explain_topk"] = with_flows(
        f"SELECT {TEST_ROWS} AS flows, 0::bigint AS wrong_length, 0::bigint AS unsorted, 0::bigint AS wrong_direction, "
        "0::bigint AS wrong_total, 0::bigint AS wrong_raw",
        UNIQUE,
    )
    return sql
