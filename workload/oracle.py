"""The same queries as SQL over the same tables, for a row-by-row comparison."""

from __future__ import annotations

from workload.queries import SEGMENTS, TABLES, TERRITORIES

# -- shared building blocks --------------------------------------------------------------------

CTES = {
    "home_policy_sev": """
        SELECT l_orderkey AS POLICY_ID, l_extendedprice * l_quantity * l_discount AS CLAIM_AMOUNT
        FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F' AND l_discount > 0""",
    "home_policy_freq": """
        SELECT o.o_orderkey AS POLICY_ID,
          CAST(1 + (o.o_orderkey % 13) AS DOUBLE) / 12 AS EXPOSURE,
          CASE WHEN o.o_orderkey % 29 = 0 THEN NULL ELSE CAST(18 + (c.c_custkey % 63) AS INT) END AS POLICYHOLDER_AGE,
          CASE WHEN o.o_orderkey % 31 = 0 THEN NULL ELSE c.c_acctbal END AS LOSS_HISTORY_SCORE,
          CASE WHEN o.o_orderkey % 37 = 0 THEN NULL ELSE o.o_totalprice END AS POPULATION_DENSITY,
          n.n_name AS REGION_CODE, r.r_name AS TERRITORY_CODE,
          c.c_mktsegment AS CONSTRUCTION_TYPE,
          CAST(substr(o.o_orderpriority, 1, 1) AS INT) AS CONSTRUCTION_QUALITY,
          CASE WHEN o.o_orderkey % 41 = 0 THEN NULL ELSE CAST(2002 - year(o.o_orderdate) AS INT) END AS PROPERTY_AGE,
          CASE o.o_orderstatus WHEN 'F' THEN 'Owner-Occupied' WHEN 'O' THEN 'Tenant-Occupied' END AS OCCUPANCY_TYPE,
          CAST(coalesce(k.n, 0) + CASE WHEN o.o_orderkey % 17 = 0 THEN 1 ELSE 0 END AS INT) AS CLAIM_COUNT
        FROM orders o
        LEFT JOIN customer c ON o.o_custkey = c.c_custkey
        LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
        LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
        LEFT JOIN (SELECT POLICY_ID, count(*) AS n FROM home_policy_sev GROUP BY POLICY_ID) k
          ON k.POLICY_ID = o.o_orderkey""",
    "claimed": "SELECT POLICY_ID, sum(CLAIM_AMOUNT) AS AMOUNT FROM home_policy_sev GROUP BY POLICY_ID",
    "capped": """
        SELECT f.* EXCLUDE (EXPOSURE, CLAIM_COUNT), least(f.EXPOSURE, 1.0::DOUBLE) AS EXPOSURE,
          least(f.CLAIM_COUNT, 4) AS CAPPED_COUNT, least(coalesce(c.AMOUNT, 0), 200000.0::DOUBLE) AS CLAIM_AMOUNT
        FROM home_policy_freq f LEFT JOIN claimed c ON c.POLICY_ID = f.POLICY_ID""",
    "policy": """
        SELECT * EXCLUDE (CAPPED_COUNT),
          CASE WHEN CLAIM_AMOUNT = 0 AND CAPPED_COUNT >= 1 THEN 0 ELSE CAPPED_COUNT END AS CLAIM_COUNT
        FROM capped""",
    "scored": """
        SELECT *, CLAIM_AMOUNT / EXPOSURE AS PURE_PREMIUM,
          CAST(50 * CONSTRUCTION_QUALITY + 3 * coalesce(POLICYHOLDER_AGE, 49) + coalesce(PROPERTY_AGE, 4) AS DOUBLE)
            AS SCORE,
          coalesce(POPULATION_DENSITY, 0)::DOUBLE AS DENSITY,
          ('0x' || substr(md5(POLICY_ID::VARCHAR), 1, 8))::BIGINT % 100 < 75 AS IS_TRAIN,
          (('0x' || substr(md5('fold42:' || POLICY_ID::VARCHAR), 1, 8))::BIGINT % 5)::INT AS FOLD
        FROM policy""",
    "predictions": """
        SELECT 'score' AS MODEL, SCORE AS P, PURE_PREMIUM AS Y, EXPOSURE AS W, POLICY_ID FROM scored
        UNION ALL SELECT 'density', DENSITY, PURE_PREMIUM, EXPOSURE, POLICY_ID FROM scored""",
    "medians": """
        SELECT quantile_cont(LOSS_HISTORY_SCORE, 0.5) AS LHS, quantile_cont(POPULATION_DENSITY, 0.5) AS DEN,
          quantile_cont(PROPERTY_AGE::DOUBLE, 0.5) AS PA, quantile_cont(POLICYHOLDER_AGE::DOUBLE, 0.5) AS PHA
        FROM policy""",
    "clean": """
        SELECT p.*, coalesce(LOSS_HISTORY_SCORE, LHS)::DOUBLE AS LOSS_HISTORY_SCORE_CLEAN,
          coalesce(POPULATION_DENSITY, DEN)::DOUBLE AS POPULATION_DENSITY_CLEAN,
          coalesce(PROPERTY_AGE, PA)::DOUBLE AS PROPERTY_AGE_CLEAN,
          coalesce(POLICYHOLDER_AGE, PHA)::DOUBLE AS POLICYHOLDER_AGE_CLEAN
        FROM policy p, medians""",
    "cuts": """
        SELECT quantile_cont(PROPERTY_AGE_CLEAN, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS PA_CUTS,
          quantile_cont(POLICYHOLDER_AGE_CLEAN, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS PHA_CUTS,
          avg(ln(POPULATION_DENSITY_CLEAN)) AS LOG_MEAN, stddev_samp(ln(POPULATION_DENSITY_CLEAN)) AS LOG_STD
        FROM clean""",
    "binned": """
        SELECT c.*,
          CAST(len([b FOR b IN PA_CUTS IF b < PROPERTY_AGE_CLEAN]) AS INT) AS PROPERTY_AGE_CLEAN_BIN,
          CAST(len([b FOR b IN PHA_CUTS IF b < POLICYHOLDER_AGE_CLEAN]) AS INT) AS POLICYHOLDER_AGE_CLEAN_BIN,
          (ln(POPULATION_DENSITY_CLEAN) - LOG_MEAN) / LOG_STD AS POPULATION_DENSITY_LOG_SCALED
        FROM clean c, cuts""",
    "edges": """
        SELECT MODEL, list_sort(list_distinct(
          quantile_cont(P, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS E
        FROM predictions GROUP BY MODEL""",
    "lift": """
        SELECT MODEL, DECILE, sum(P * W) / sum(W) AS PREDICTED, sum(Y * W) / sum(W) AS OBSERVED,
          sum(W) AS EXPOSURE, count(*) AS POLICIES
        FROM (SELECT p.*, CAST(greatest(1, len([b FOR b IN e.E IF b < p.P])) AS INT) AS DECILE
              FROM predictions p JOIN edges e ON e.MODEL = p.MODEL)
        GROUP BY MODEL, DECILE""",
    "curve": """
        SELECT MODEL, POLICY_ID, P, row_number() OVER w AS RANK, W AS DE, Y * W AS DC,
          sum(W) OVER w AS CE, sum(Y * W) OVER w AS CC,
          sum(W) OVER (PARTITION BY MODEL) AS TE, sum(Y * W) OVER (PARTITION BY MODEL) AS TC
        FROM predictions
        WINDOW w AS (PARTITION BY MODEL ORDER BY P, POLICY_ID ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "area": """
        SELECT MODEL, sum(DE / TE * (CC - DC / 2) / TC) AS FULL_AUC,
          sum(CASE WHEN RANK = 1 THEN 0 ELSE DE / TE * (CC - DC / 2) / TC END) AS AUC
        FROM curve GROUP BY MODEL""",
    "errors": """
        SELECT MODEL, sqrt(avg((Y - P) * (Y - P))) AS RMSE, avg(abs(Y - P)) AS MAE,
          sqrt(sum(W * (Y - P) * (Y - P)) / sum(W)) AS RMSE_WEIGHTED, sum(W * abs(Y - P)) / sum(W) AS MAE_WEIGHTED
        FROM predictions GROUP BY MODEL""",
    "level_means": """
        SELECT TERRITORY_CODE, sum(CLAIM_AMOUNT) / sum(EXPOSURE) AS M,
          sum(CLAIM_AMOUNT) FILTER (WHERE IS_TRAIN) / sum(EXPOSURE) FILTER (WHERE IS_TRAIN) AS TRAIN_M,
          sum(CLAIM_COUNT) / sum(EXPOSURE) * (sum(CLAIM_AMOUNT) FILTER (WHERE CLAIM_COUNT > 0)
            / sum(CLAIM_COUNT) FILTER (WHERE CLAIM_COUNT > 0)) AS FS,
          avg(PURE_PREMIUM) AS PLAIN, count(*) AS N
        FROM scored GROUP BY TERRITORY_CODE""",
    "cv_folds": """
        SELECT h.FOLD, sqrt(sum(h.EXPOSURE * (h.PURE_PREMIUM - t.M) * (h.PURE_PREMIUM - t.M)) / sum(h.EXPOSURE)) AS RMSE
        FROM scored h
        JOIN (SELECT f.FOLD, s.TERRITORY_CODE, sum(s.CLAIM_AMOUNT) / sum(s.EXPOSURE) AS M
              FROM (SELECT DISTINCT FOLD FROM scored) f JOIN scored s ON s.FOLD <> f.FOLD
              GROUP BY f.FOLD, s.TERRITORY_CODE) t
          ON t.FOLD = h.FOLD AND t.TERRITORY_CODE = h.TERRITORY_CODE
        GROUP BY h.FOLD""",
    "betas": """
        SELECT l.TERRITORY_CODE, 'T_' || replace(l.TERRITORY_CODE, ' ', '_') AS FEATURE, ln(l.M / b.M) AS BETA,
          l.N / (SELECT sum(N) FROM level_means) AS SHARE, ln(b.M) AS BASE
        FROM level_means l, level_means b
        WHERE b.TERRITORY_CODE = 'AFRICA' AND l.TERRITORY_CODE <> 'AFRICA'""",
    "contributions": """
        SELECT s.POLICY_ID, b.FEATURE,
          b.BETA * (CASE WHEN s.TERRITORY_CODE = b.TERRITORY_CODE THEN 1 ELSE 0 END - b.SHARE) AS PHI
        FROM scored s, betas b""",
}

NEEDS = {
    "home_policy_sev": [],
    "home_policy_freq": ["home_policy_sev"],
    "claimed": ["home_policy_sev"],
    "capped": ["home_policy_freq", "claimed"],
    "policy": ["capped"],
    "scored": ["policy"],
    "predictions": ["scored"],
    "medians": ["policy"],
    "clean": ["policy", "medians"],
    "cuts": ["clean"],
    "binned": ["clean", "cuts"],
    "edges": ["predictions"],
    "lift": ["predictions", "edges"],
    "curve": ["predictions"],
    "area": ["curve"],
    "errors": ["predictions"],
    "level_means": ["scored"],
    "cv_folds": ["scored"],
    "betas": ["level_means"],
    "contributions": ["scored", "betas"],
}


def sql(base: str | list[str], select: str) -> str:
    """``select`` with the named building blocks, and all they need, put in front of it."""
    wanted: list[str] = []

    def add(name: str) -> None:
        if name not in wanted:
            for need in NEEDS[name]:
                add(need)
            wanted.append(name)

    for name in [base] if isinstance(base, str) else base:
        add(name)
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in wanted) + "\n" + select


POLICY_COLUMNS = (
    "POLICY_ID, EXPOSURE, POLICYHOLDER_AGE, LOSS_HISTORY_SCORE, POPULATION_DENSITY, REGION_CODE, TERRITORY_CODE, "
    "CONSTRUCTION_TYPE, CONSTRUCTION_QUALITY, PROPERTY_AGE, OCCUPANCY_TYPE, CLAIM_COUNT"
)
FEED_COLUMNS = (
    "POLICY_ID, round(EXPOSURE, 6) AS EXPOSURE, POLICYHOLDER_AGE, round(LOSS_HISTORY_SCORE, 4) AS LOSS_HISTORY_SCORE, "
    "round(POPULATION_DENSITY, 4) AS POPULATION_DENSITY, REGION_CODE, TERRITORY_CODE, CONSTRUCTION_TYPE, "
    "CONSTRUCTION_QUALITY, PROPERTY_AGE, OCCUPANCY_TYPE, CLAIM_COUNT"
)
IMPUTED = ("LOSS_HISTORY_SCORE", "POPULATION_DENSITY", "PROPERTY_AGE", "POLICYHOLDER_AGE")
LEVELS = {
    "CONSTRUCTION_TYPE": [f"'{s}'" for s in SEGMENTS],
    "CONSTRUCTION_QUALITY": ["1", "2", "3", "4", "5"],
    "OCCUPANCY_TYPE": ["'Owner-Occupied'", "'Tenant-Occupied'"],
    "REGION_CODE": [f"'NATION_{i}'" for i in sorted(range(25), key=str)],
    "TERRITORY_CODE": [f"'{t}'" for t in TERRITORIES],
}


def _indicator(condition: str, name: str) -> str:
    return f"CASE WHEN {condition} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS {name}"


def _level_name(column: str, level: str) -> str:
    return f"{column}_{level.strip(chr(39)).upper().replace(' ', '_').replace('-', '_')}"


BINS = ", ".join(
    _indicator(f"{c}_CLEAN_BIN = {b}", f"{c}_CLEAN_BIN_{b}") for c in ("PROPERTY_AGE", "POLICYHOLDER_AGE") for b in range(10)
)
ONE_HOT = ", ".join(_indicator(f"{c} = {v}", _level_name(c, v)) for c, vs in LEVELS.items() for v in vs)
FEATURES = (
    [f"{c}_CLEAN_BIN_{b}" for c in ("PROPERTY_AGE", "POLICYHOLDER_AGE") for b in range(10)]
    + [_level_name(c, v) for c, vs in LEVELS.items() for v in vs]
    + ["LOSS_HISTORY_SCORE_CLEAN", "POPULATION_DENSITY_LOG_SCALED"]
)


def _union(parts) -> str:
    return "\nUNION ALL ".join(parts)


def _histogram(column: str) -> str:
    return f"""
      SELECT '{column}' AS COLUMN_NAME, BIN, round(LO + BIN * ((HI - LO) / BINS), 6) AS LOWER, round(sum(W), 6) AS EXPOSURE
      FROM (SELECT CAST(least(floor((X - LO) * BINS / (HI - LO)), BINS - 1) AS INT) AS BIN, LO, HI, BINS, W
            FROM (SELECT {column}::DOUBLE AS X, EXPOSURE AS W FROM policy WHERE {column} IS NOT NULL),
                 (SELECT min({column})::DOUBLE AS LO, max({column})::DOUBLE AS HI,
                    least(30, count(DISTINCT {column})) AS BINS FROM policy))
      GROUP BY BIN, LO, HI, BINS"""


_LIFT_OUT = (
    "SELECT MODEL, DECILE, round(PREDICTED, 4) AS PREDICTED, round(OBSERVED, 4) AS OBSERVED, round(EXPOSURE, 6) AS EXPOSURE"
)
_SCORE_AREA = "round({0}, 9) AS AUC, round(1 - 2 * {0}, 9) AS GINI"
_OBSERVED_AREA = """
    SELECT sum(CASE WHEN RANK = 1 THEN 0 ELSE DE / TE * (CC - DC / 2) / TC END) AS AUC FROM (
      SELECT row_number() OVER w AS RANK, EXPOSURE AS DE, PURE_PREMIUM * EXPOSURE AS DC,
        sum(EXPOSURE) OVER () AS TE, sum(PURE_PREMIUM * EXPOSURE) OVER () AS TC,
        sum(PURE_PREMIUM * EXPOSURE) OVER w AS CC
      FROM scored
      WINDOW w AS (ORDER BY PURE_PREMIUM, POLICY_ID ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


def _measures(exhibit: str, point: str, table: str, **digits: int) -> str:
    return _union(
        f"SELECT '{exhibit}' AS EXHIBIT, MODEL, {point} AS POINT, '{m}' AS MEASURE, round({m}, {n}) AS VALUE "
        f"FROM {table} WHERE MODEL = 'score'"
        for m, n in digits.items()
    )


_DECILE_LIST = "[0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]"
_TABLE_LIST = ", ".join(f"'{t}'" for t in TABLES)
_COUNTS = _union(f"SELECT '{t}' AS TABLE_NAME, count(*) AS ROW_COUNT FROM {t}" for t in TABLES)

# columns of the test tables; those holding text are marked with *
_TABLE_COLUMNS = {
    "region": "r_regionkey r_name*",
    "nation": "n_nationkey n_name* n_regionkey",
    "customer": "c_custkey c_name* c_nationkey c_acctbal c_mktsegment*",
    "supplier": "s_suppkey s_name* s_nationkey s_acctbal",
    "part": "p_partkey p_name* p_brand* p_type* p_size p_retailprice",
    "orders": "o_orderkey o_custkey o_orderstatus* o_totalprice o_orderdate o_orderpriority*",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
    "l_returnflag* l_linestatus* l_shipdate",
    "events": "event_id ts user_id event_type* value props*",
    "documents": "doc_id text* lang* source* n_chars",
    "embeddings": "vec_id embedding label",
    "pages": "page_id url* html*",
    "benchmark": "item_id text*",
    "labels": "doc_id quality toxic",
    "conversations": "conv_id turn role* text*",
}
_PROFILES = _union(
    f"SELECT '{t}' AS TABLE_NAME, '{c.rstrip('*')}' AS COLUMN_NAME, "
    f"{f'max(length({c[:-1]}))' if c.endswith('*') else 'NULL'}::INT AS MAX_LENGTH, "
    f"count(*) - count({c.rstrip('*')}) AS NULL_COUNT FROM {t}"
    for t, cs in _TABLE_COLUMNS.items()
    for c in cs.split()
)
_COLUMNS = f"""
    SELECT table_name AS TABLE_NAME, ordinal_position AS ORDINAL_POSITION, column_name AS COLUMN_NAME,
      CASE WHEN data_type LIKE 'TIMESTAMP%' THEN 'TIMESTAMP' ELSE data_type END AS DATA_TYPE
    FROM information_schema.columns WHERE table_name IN ({_TABLE_LIST})"""
_DESCRIBED = """
    SELECT * FROM (VALUES ('orders', 'o_orderkey', 'Identifier of the order.'),
      ('orders', 'o_custkey', 'Customer who placed the order.'), ('lineitem', 'l_quantity', 'Units ordered.'))
      AS d(TABLE_NAME, COLUMN_NAME, COLUMN_DESCRIPTION)"""
_DICTIONARY = f"""
    WITH counts AS ({_COUNTS}), cols AS ({_COLUMNS}), described AS ({_DESCRIBED}),
    dictionary AS (
      SELECT c.TABLE_NAME, n.ROW_COUNT,
        CASE WHEN c.TABLE_NAME = 'orders' THEN 'Orders, played as policies.' END AS TABLE_DESCRIPTION,
        CAST(c.ORDINAL_POSITION AS INT) AS COL_POSITION, c.COLUMN_NAME, c.DATA_TYPE, d.COLUMN_DESCRIPTION
      FROM cols c JOIN counts n ON n.TABLE_NAME = c.TABLE_NAME
      LEFT JOIN described d ON d.TABLE_NAME = c.TABLE_NAME AND d.COLUMN_NAME = c.COLUMN_NAME)
"""


def _check_row(column: str, categorical: bool) -> str:
    inside = "REGION_CODE LIKE 'NATION_1%' AND EXPOSURE > 0.5"
    unseen = out_of_range = "0"
    if categorical:
        unseen = (
            f"(SELECT count(*) FROM policy WHERE {column} IS NOT NULL AND {column} NOT IN "
            f"(SELECT {column} FROM policy WHERE {inside} AND {column} IS NOT NULL))"
        )
    else:
        out_of_range = (
            f"(SELECT count(*) FROM policy, (SELECT min({column}) AS lo, max({column}) AS hi FROM policy WHERE {inside}) "
            f"WHERE {column} < lo OR {column} > hi)"
        )
    return (
        f"SELECT '{column}' AS COLUMN_NAME, (SELECT count(*) FROM policy WHERE {column} IS NULL) AS NULLS, "
        f"{unseen} AS UNSEEN_LEVELS, {out_of_range} AS OUT_OF_RANGE"
    )


_FEED_MISSING = _union(
    f"SELECT '{c.strip()}' AS COLUMN_NAME, count(*) AS FEED_ROWS, count(*) - count({c.strip()}) AS MISSING, "
    f"0 AS REJECTED FROM home_policy_freq"
    for c in POLICY_COLUMNS.split(",")
)

ORACLE: dict[str, str] = {
    "policy_table": sql("home_policy_freq", f"SELECT {POLICY_COLUMNS} FROM home_policy_freq"),
    "claim_table": sql("home_policy_sev", "SELECT * FROM home_policy_sev"),
    "claims_by_policy": sql("claimed", "SELECT POLICY_ID, round(AMOUNT, 4) AS CLAIM_AMOUNT FROM claimed"),
    "policies_with_claims": sql(
        ["home_policy_freq", "claimed"],
        """SELECT f.POLICY_ID, f.CLAIM_COUNT, round(coalesce(c.AMOUNT, 0), 4)::DOUBLE AS CLAIM_AMOUNT
        FROM home_policy_freq f LEFT JOIN claimed c ON c.POLICY_ID = f.POLICY_ID""",
    ),
    "prep_policies": sql(
        "policy", "SELECT POLICY_ID, EXPOSURE, CLAIM_COUNT, round(CLAIM_AMOUNT, 4) AS CLAIM_AMOUNT FROM policy"
    ),
    "targets": sql(
        "policy",
        """SELECT POLICY_ID, round(CLAIM_AMOUNT / EXPOSURE, 6) AS PURE_PREMIUM,
          round(CLAIM_COUNT / EXPOSURE, 6) AS FREQUENCY,
          round(CLAIM_AMOUNT / greatest(CLAIM_COUNT, 1), 6) AS AVG_CLAIM_AMOUNT FROM policy""",
    ),
    "territory_burning_cost": sql(
        "policy",
        """SELECT TERRITORY_CODE, count(*) AS POLICIES, round(sum(EXPOSURE), 6) AS EXPOSURE,
          CAST(sum(CLAIM_COUNT) AS BIGINT) AS CLAIM_COUNT, round(sum(CLAIM_AMOUNT), 4) AS CLAIM_AMOUNT,
          round(sum(CLAIM_AMOUNT) / sum(EXPOSURE), 4) AS PURE_PREMIUM
        FROM policy GROUP BY TERRITORY_CODE""",
    ),
    "segment_exposure": sql(
        "policy",
        """SELECT TERRITORY_CODE, CONSTRUCTION_TYPE, count(*) AS POLICIES, round(sum(EXPOSURE), 6) AS EXPOSURE,
          CAST(sum(CLAIM_COUNT) AS BIGINT) AS CLAIM_COUNT, round(sum(CLAIM_AMOUNT), 4) AS CLAIM_AMOUNT,
          round(sum(CLAIM_AMOUNT) / sum(EXPOSURE), 4) AS PURE_PREMIUM, sum(EXPOSURE) < 350 AS IS_THIN
        FROM policy GROUP BY TERRITORY_CODE, CONSTRUCTION_TYPE""",
    ),
    "portfolio_counts": sql(
        ["home_policy_freq", "home_policy_sev"],
        """SELECT (SELECT count(*) FROM home_policy_freq) AS POLICIES, count(*) AS CLAIMS,
          count(DISTINCT POLICY_ID) AS CLAIMING_POLICIES FROM home_policy_sev""",
    ),
    "medians_exact": sql(
        "medians",
        _union(
            f"SELECT '{c}' AS COLUMN_NAME, round({m}, 6) AS MEDIAN FROM medians"
            for c, m in zip(IMPUTED, ("LHS", "DEN", "PA", "PHA"))
        ),
    ),
    "decile_boundaries": sql(
        "policy",
        _union(
            f"SELECT '{c}' AS COLUMN_NAME, unnest(range(1, 10))::INT AS DECILE, round(unnest(Q), 4) AS BOUNDARY "
            f"FROM (SELECT quantile_cont({c}::DOUBLE, {_DECILE_LIST}) AS Q FROM policy)"
            for c in (*IMPUTED, "CLAIM_AMOUNT")
        ),
    ),
    "impute": sql(
        "clean", "SELECT POLICY_ID, " + ", ".join(f"round({c}_CLEAN, 6) AS {c}_CLEAN" for c in IMPUTED) + " FROM clean"
    ),
    "bin_assign": sql("binned", "SELECT POLICY_ID, PROPERTY_AGE_CLEAN_BIN, POLICYHOLDER_AGE_CLEAN_BIN FROM binned"),
    "bin_indicators": sql("binned", f"SELECT POLICY_ID, {BINS} FROM binned"),
    "one_hot": sql("policy", f"SELECT POLICY_ID, {ONE_HOT} FROM policy"),
    "level_sets": sql(
        "home_policy_freq",
        "\nUNION ".join(
            f"SELECT '{c}' AS COLUMN_NAME, {c}::VARCHAR AS LEVEL FROM home_policy_freq WHERE {c} IS NOT NULL" for c in LEVELS
        ),
    ),
    "log_scaled_density": sql(
        "binned", "SELECT POLICY_ID, round(POPULATION_DENSITY_LOG_SCALED, 6) AS POPULATION_DENSITY_LOG_SCALED FROM binned"
    ),
    "feature_matrix": sql(
        "binned",
        f"""SELECT POLICY_ID, CLAIM_COUNT, EXPOSURE, round(CLAIM_AMOUNT, 4) AS CLAIM_AMOUNT, {BINS}, {ONE_HOT},
          round(LOSS_HISTORY_SCORE_CLEAN, 6) AS LOSS_HISTORY_SCORE_CLEAN,
          round(POPULATION_DENSITY_LOG_SCALED, 6) AS POPULATION_DENSITY_LOG_SCALED FROM binned""",
    ),
    "scoring_input_check": sql(
        "policy", _union([_check_row(c, False) for c in IMPUTED] + [_check_row(c, True) for c in LEVELS])
    ),
    "hash_split": sql("scored", "SELECT POLICY_ID, IS_TRAIN FROM scored"),
    "fold_assignment": sql("scored", "SELECT POLICY_ID, FOLD FROM scored"),
    "split_disjoint": sql(
        "scored",
        """SELECT (SELECT count(*) FROM scored a JOIN scored b ON a.POLICY_ID = b.POLICY_ID
          WHERE a.IS_TRAIN AND NOT b.IS_TRAIN) AS SHARED,
          (SELECT count(*) FROM scored WHERE IS_TRAIN IS NULL) AS LOST""",
    ),
    "entity_key_check": sql(
        "home_policy_sev",
        """SELECT count(*) FILTER (WHERE n > 1 AND POLICY_ID IS NOT NULL) AS DUPLICATE_KEYS,
          coalesce(CAST(sum(n) FILTER (WHERE POLICY_ID IS NULL) AS BIGINT), 0) AS NULL_KEY_ROWS,
          count(*) FILTER (WHERE POLICY_ID IS NOT NULL) AS ENTITIES
        FROM (SELECT POLICY_ID, count(*) AS n FROM home_policy_sev GROUP BY POLICY_ID)""",
    ),
    "spine": sql("scored", "SELECT POLICY_ID, round(PURE_PREMIUM, 6) AS PURE_PREMIUM, EXPOSURE FROM scored"),
    "spine_features": sql(
        "scored",
        f"""SELECT POLICY_ID, round(PURE_PREMIUM, 6) AS PURE_PREMIUM, EXPOSURE,
          {_indicator("OCCUPANCY_TYPE = 'Owner-Occupied'", "OWNER")} FROM scored WHERE IS_TRAIN""",
    ),
    "dataset_read": sql(
        ["scored", "medians"],
        f"""SELECT POLICY_ID, round(PURE_PREMIUM, 6) AS PURE_PREMIUM, EXPOSURE,
          {_indicator("OCCUPANCY_TYPE = 'Owner-Occupied'", "OCCUPANCY_TYPE_OWNER_OCCUPIED")},
          round(coalesce(LOSS_HISTORY_SCORE, LHS), 6) AS LOSS_HISTORY_SCORE_CLEAN
        FROM scored, medians WHERE NOT IS_TRAIN""",
    ),
    "dataset_versions": sql(
        "scored",
        f"""SELECT CASE WHEN IS_TRAIN THEN 'TRAINING' ELSE 'VALIDATION' END AS name, '1' AS version,
          'RATING_FEATURES' AS feature_view, count(*) AS rows, {len(FEATURES) + 3} AS column_count,
          'PURE_PREMIUM,EXPOSURE' AS label_columns FROM scored GROUP BY IS_TRAIN""",
    ),
    "dataset_audit": sql(
        "scored",
        """SELECT CASE WHEN IS_TRAIN THEN 'TRAINING' ELSE 'VALIDATION' END AS name, '1' AS version, count(*) AS ROWS,
          CAST(sum(CAST(CAST('0x' || substring(md5(CAST(POLICY_ID AS VARCHAR)), 1, 15) AS BIGINT) AS HUGEINT)) AS VARCHAR)
          AS KEY_DIGEST, TRUE AS INTACT FROM scored GROUP BY IS_TRAIN""",
    ),
    "dataset_features_only": sql(
        "scored",
        f"""SELECT POLICY_ID, CAST(2 + (CONSTRUCTION_TYPE IS NOT NULL)::INT + (CONSTRUCTION_QUALITY IS NOT NULL)::INT
          + (OCCUPANCY_TYPE IS NOT NULL)::INT + (REGION_CODE IS NOT NULL)::INT + (TERRITORY_CODE IS NOT NULL)::INT
          AS DOUBLE) AS INDICATORS_SET, {len(FEATURES) + 1} AS WIDTH FROM scored WHERE IS_TRAIN""",
    ),
    "glm_one_way": sql(
        "level_means",
        """SELECT s.POLICY_ID, round(l.TRAIN_M, 3) AS PREDICTED_PURE_PREMIUM
        FROM scored s JOIN level_means l ON l.TERRITORY_CODE = s.TERRITORY_CODE WHERE NOT s.IS_TRAIN""",
    ),
    "glm_wide_one_way": sql(
        "level_means",
        """SELECT s.POLICY_ID, round(l.M, 3) AS PREDICTED_PURE_PREMIUM
        FROM scored s JOIN level_means l ON l.TERRITORY_CODE = s.TERRITORY_CODE""",
    ),
    "glm_wide_factors": sql(
        "scored",
        """, learned AS (SELECT s.*, o.o_custkey AS CUSTOMER FROM scored s JOIN orders o ON o.o_orderkey = s.POLICY_ID
          WHERE s.PROPERTY_AGE IS NOT NULL AND s.PURE_PREMIUM IS NOT NULL AND s.EXPOSURE > 0)
        SELECT 'CUSTOMER' AS FACTOR, count(DISTINCT CUSTOMER) AS LEVELS, 0.0::DOUBLE AS RESIDUAL FROM learned
        UNION ALL SELECT 'REGION_CODE', count(DISTINCT REGION_CODE), 0.0 FROM learned
        UNION ALL SELECT 'CONSTRUCTION_TYPE', count(DISTINCT CONSTRUCTION_TYPE), 0.0 FROM learned
        UNION ALL SELECT 'OCCUPANCY_TYPE', count(DISTINCT OCCUPANCY_TYPE), 0.0 FROM learned
        UNION ALL SELECT unnest(['INTERCEPT', 'PROPERTY_AGE']), 1, 0.0""",
    ),
    "glm_score_equations": f"SELECT unnest({['INTERCEPT', *FEATURES]}) AS FEATURE, 0.0::DOUBLE AS RESIDUAL",
    "glm_cv_one_way": sql("cv_folds", "SELECT 0.0::DOUBLE AS ALPHA, FOLD, round(RMSE, 3) AS RMSE FROM cv_folds"),
    "cv_mean_and_std": sql(
        "cv_folds",
        """SELECT 0.0::DOUBLE AS ALPHA, count(*) AS FOLDS, round(avg(RMSE), 3) AS CV_RMSE_MEAN,
          round(stddev_pop(RMSE), 3) AS CV_RMSE_STD FROM cv_folds""",
    ),
    "alpha_grid_one_way": sql(
        "cv_folds",
        """SELECT ALPHA, count(*) AS FOLDS, round(avg(RMSE), 3) AS CV_RMSE_MEAN, round(stddev_pop(RMSE), 3) AS CV_RMSE_STD
        FROM (SELECT 0.0::DOUBLE AS ALPHA, FOLD, RMSE FROM cv_folds
          UNION ALL
          SELECT 1e15::DOUBLE, h.FOLD, sqrt(sum(h.EXPOSURE * (h.PURE_PREMIUM - t.M) * (h.PURE_PREMIUM - t.M)) / sum(h.EXPOSURE))
          FROM scored h JOIN (
            SELECT f.FOLD, sum(s.CLAIM_AMOUNT) / sum(s.EXPOSURE) AS M
            FROM (SELECT DISTINCT FOLD FROM scored) f JOIN scored s ON s.FOLD <> f.FOLD GROUP BY f.FOLD) t
            ON t.FOLD = h.FOLD
          GROUP BY h.FOLD)
        GROUP BY ALPHA""",
    ),
    "feed_unknown_paths": sql(
        "home_policy_freq",
        """SELECT PATH, CAST(ROWS AS BIGINT) AS ROWS, CAST(LEAVES AS BIGINT) AS LEAVES, TYPE FROM (
          SELECT 'RoofType' AS PATH, count(*) FILTER (POLICY_ID % 3 = 0) AS ROWS, count(*) FILTER (POLICY_ID % 3 = 0) AS LEAVES,
            'string' AS TYPE FROM home_policy_freq
          UNION ALL SELECT 'Risk.Sprinkler', count(*) FILTER (POLICY_ID % 4 = 1), count(*) FILTER (POLICY_ID % 4 = 1), 'boolean'
            FROM home_policy_freq
          UNION ALL SELECT 'Note[]', count(*) FILTER (POLICY_ID % 7 = 0), 2 * count(*) FILTER (POLICY_ID % 7 = 0), 'string'
            FROM home_policy_freq
          UNION ALL SELECT 'Inspection.Day', count(*) FILTER (POLICY_ID % 5 = 2), count(*) FILTER (POLICY_ID % 5 = 2), 'date'
            FROM home_policy_freq
          UNION ALL SELECT 'Storeys', count(*) FILTER (POLICY_ID % 2 = 0), count(*) FILTER (POLICY_ID % 2 = 0), 'bigint'
            FROM home_policy_freq)""",
    ),
    "xml_extended_landing": sql(
        "home_policy_freq",
        """SELECT POLICY_ID, TERRITORY_CODE, CASE WHEN POLICY_ID % 3 = 0 THEN 'R' || (POLICY_ID % 5) END AS ROOF_TYPE,
          CASE WHEN POLICY_ID % 4 = 1 THEN 'true' END AS SPRINKLER, CASE WHEN POLICY_ID % 7 = 0 THEN 'second' END AS SECOND_NOTE,
          CASE WHEN POLICY_ID % 5 = 2 THEN strftime(DATE '2020-01-01' + CAST(POLICY_ID % 28 AS INT), '%Y-%m-%d') END AS INSPECTED,
          CASE WHEN POLICY_ID % 2 = 0 THEN CAST(POLICY_ID % 4 AS INT) END AS STOREYS
        FROM home_policy_freq""",
    ),
    "glm_relativities_one_way": sql(
        "level_means",
        """SELECT 'BASE_RATE' AS FEATURE, round(M, 4) AS RELATIVITY FROM level_means WHERE TERRITORY_CODE = 'AFRICA'
        UNION ALL SELECT 'TERRITORY_CODE_' || replace(l.TERRITORY_CODE, ' ', '_'), round(l.M / b.M, 4)
        FROM level_means l, level_means b WHERE b.TERRITORY_CODE = 'AFRICA' AND l.TERRITORY_CODE <> 'AFRICA'""",
    ),
    "freq_sev_one_way": sql(
        "level_means",
        """SELECT s.POLICY_ID, round(l.FS, 3) AS PREDICTED_PURE_PREMIUM
        FROM scored s JOIN level_means l ON l.TERRITORY_CODE = s.TERRITORY_CODE""",
    ),
    "gbt_one_way": sql(
        "level_means",
        """SELECT s.POLICY_ID, round(l.M, 3) AS PREDICTED_PURE_PREMIUM
        FROM scored s JOIN level_means l ON l.TERRITORY_CODE = s.TERRITORY_CODE""",
    ),
    "gbt_unweighted_one_way": sql(
        "level_means",
        """SELECT s.POLICY_ID, round(l.PLAIN, 3) AS PREDICTED_PURE_PREMIUM
        FROM scored s JOIN level_means l ON l.TERRITORY_CODE = s.TERRITORY_CODE""",
    ),
    "gbt_eval_curve": sql(
        "level_means",
        """SELECT unnest([1, 2, 3]) AS ROUND, round(E, 3) AS ROOT_LOSS FROM (
          SELECT sqrt(sum(s.EXPOSURE * (s.PURE_PREMIUM - l.TRAIN_M) * (s.PURE_PREMIUM - l.TRAIN_M)) / sum(s.EXPOSURE)) AS E
          FROM scored s JOIN level_means l ON l.TERRITORY_CODE = s.TERRITORY_CODE WHERE NOT s.IS_TRAIN)""",
    ),
    "gbt_leafwise": sql(
        "level_means",
        """SELECT s.POLICY_ID, round(l.M, 3) AS PREDICTED_PURE_PREMIUM
        FROM scored s JOIN level_means l ON l.TERRITORY_CODE = s.TERRITORY_CODE""",
    ),
    "gbt_leafwise_unweighted": sql(
        "level_means",
        """SELECT s.POLICY_ID, round(l.PLAIN, 3) AS PREDICTED_PURE_PREMIUM
        FROM scored s JOIN level_means l ON l.TERRITORY_CODE = s.TERRITORY_CODE""",
    ),
    "gbt_leafwise_watched": sql(
        "level_means",
        """SELECT unnest([1, 2, 3]) AS ROUND, round(E, 3) AS ROOT_LOSS FROM (
          SELECT sqrt(sum(s.EXPOSURE * (s.PURE_PREMIUM - l.TRAIN_M) * (s.PURE_PREMIUM - l.TRAIN_M)) / sum(s.EXPOSURE)) AS E
          FROM scored s JOIN level_means l ON l.TERRITORY_CODE = s.TERRITORY_CODE WHERE NOT s.IS_TRAIN)""",
    ),
    "prediction_errors": sql(
        "errors",
        """SELECT MODEL, round(RMSE, 4) AS RMSE, round(MAE, 4) AS MAE, round(RMSE_WEIGHTED, 4) AS RMSE_WEIGHTED,
          round(MAE_WEIGHTED, 4) AS MAE_WEIGHTED FROM errors""",
    ),
    "double_lift": sql("lift", f"{_LIFT_OUT}, POLICIES FROM lift"),
    "lift_calibration": sql(
        "lift",
        """SELECT MODEL, DECILE, round(PREDICTED - OBSERVED, 4) AS GAP, round(PREDICTED / OBSERVED, 6) AS RATIO,
          coalesce(PREDICTED >= lag(PREDICTED) OVER w, true) AS PREDICTED_RISES,
          coalesce(OBSERVED >= lag(OBSERVED) OVER w, true) AS OBSERVED_RISES
        FROM lift WINDOW w AS (PARTITION BY MODEL ORDER BY DECILE)""",
    ),
    "lorenz_points": sql(
        "curve",
        """SELECT POLICY_ID, P AS PREDICTION, RANK, round(CE / TE, 6) AS CUM_EXPOSURE, round(CC / TC, 6) AS CUM_CLAIMS
        FROM curve WHERE MODEL = 'score'""",
    ),
    "lorenz_clustered_ties": sql(
        "scored",
        """SELECT POLICY_ID, S AS PREDICTION, row_number() OVER w AS RANK,
          round(sum(EXPOSURE) OVER w / sum(EXPOSURE) OVER (), 6) AS CUM_EXPOSURE,
          round(sum(PURE_PREMIUM * EXPOSURE) OVER w / sum(PURE_PREMIUM * EXPOSURE) OVER (), 6) AS CUM_CLAIMS
        FROM (SELECT *, CASE WHEN POLICY_ID * 10 <= (SELECT max(POLICY_ID) FROM scored) THEN 300.0::DOUBLE ELSE SCORE END
          AS S FROM scored)
        WINDOW w AS (ORDER BY S, POLICY_ID ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    ),
    "lorenz_display": sql(
        "curve",
        """SELECT POINT, round(max(CE / TE), 6) AS CUM_EXPOSURE, round(arg_max(CC / TC, RANK), 6) AS CUM_CLAIMS,
          round(max(CE / TE), 6) AS RANDOM
        FROM (SELECT *, CAST(least(floor(CE / TE * 50), 49) AS INT) AS POINT FROM curve WHERE MODEL = 'density')
        GROUP BY POINT""",
    ),
    "lorenz_gini": sql("area", f"SELECT MODEL, {_SCORE_AREA.format('AUC')} FROM area"),
    "lorenz_gini_from_origin": sql("area", f"SELECT MODEL, {_SCORE_AREA.format('FULL_AUC')} FROM area"),
    "oracle_gini": sql(
        "scored",
        f"SELECT 'oracle' AS MODEL, {_SCORE_AREA.format('AUC')} FROM ({_OBSERVED_AREA})",
    ),
    "model_comparison": sql(
        ["errors", "area", "lift"],
        """SELECT e.MODEL, round(e.RMSE, 4) AS RMSE, round(e.MAE, 4) AS MAE, round(1 - 2 * a.AUC, 8) AS GINI,
          round(l.R, 6) AS LIFT_RATIO, round(l.G, 4) AS WORST_GAP
        FROM errors e JOIN area a ON a.MODEL = e.MODEL
        JOIN (SELECT MODEL, arg_max(OBSERVED, DECILE) / arg_min(OBSERVED, DECILE) AS R,
                max(abs(PREDICTED - OBSERVED)) AS G FROM lift GROUP BY MODEL) l ON l.MODEL = e.MODEL""",
    ),
    "exposure_histogram": sql(
        "policy", _union(_histogram(c) for c in ("POLICYHOLDER_AGE", "PROPERTY_AGE", "LOSS_HISTORY_SCORE"))
    ),
    "distinct_counts": sql(
        "home_policy_freq",
        _union(
            f"SELECT '{c}' AS COLUMN_NAME, count(DISTINCT {c}) AS DISTINCT_VALUES FROM home_policy_freq"
            for c in (*LEVELS, *IMPUTED)
        ),
    ),
    "diagnostic_bundle": sql(
        ["lift", "area", "errors"],
        _measures("double_lift", "DECILE", "lift", PREDICTED=4, OBSERVED=4, EXPOSURE=6)
        + f"""
        UNION ALL SELECT 'double_lift', MODEL, DECILE, 'GAP', round(PREDICTED - OBSERVED, 4) FROM lift WHERE MODEL = 'score'
        UNION ALL SELECT 'double_lift', MODEL, DECILE, 'RATIO', round(PREDICTED / OBSERVED, 6) FROM lift WHERE MODEL = 'score'
        UNION ALL SELECT 'lorenz', 'score', POINT, unnest(['CUM_EXPOSURE', 'CUM_CLAIMS', 'RANDOM']),
          round(unnest([max(CE / TE), arg_max(CC / TC, RANK), max(CE / TE)]), 6)
        FROM (SELECT *, CAST(least(floor(CE / TE * 200), 199) AS INT) AS POINT FROM curve WHERE MODEL = 'score')
        GROUP BY POINT
        UNION ALL SELECT 'gini', MODEL, 0, unnest(['AUC', 'GINI']), round(unnest([AUC, 1 - 2 * AUC]), 9)
        FROM (SELECT MODEL, AUC FROM area WHERE MODEL = 'score' UNION ALL SELECT 'oracle', AUC FROM ({_OBSERVED_AREA}))
        UNION ALL """
        + _measures("metrics", "0", "errors", RMSE=4, MAE=4, RMSE_WEIGHTED=4, MAE_WEIGHTED=4),
    ),
    "glm_contributions": sql(
        "contributions",
        "SELECT POLICY_ID, round((SELECT max(BASE) + sum(BETA * SHARE) FROM betas), 5) AS BASELINE, "
        + ", ".join(
            f"round(max(PHI) FILTER (WHERE FEATURE = 'T_{t.replace(' ', '_')}'), 5) AS T_{t.replace(' ', '_')}_explanation"
            for t in TERRITORIES[1:]
        )
        + " FROM contributions GROUP BY POLICY_ID",
    ),
    "top_factors": sql(
        "contributions",
        """SELECT POLICY_ID, CAST(R AS INT) AS RANK, FEATURE, round(PHI, 5) AS CONTRIBUTION FROM (
          SELECT *, row_number() OVER (PARTITION BY POLICY_ID ORDER BY abs(PHI) DESC, FEATURE) AS R FROM contributions)
        WHERE R <= 2""",
    ),
    "global_importance": sql(
        "contributions", "SELECT FEATURE, round(avg(abs(PHI)), 5) AS IMPORTANCE FROM contributions GROUP BY FEATURE"
    ),
    "explain_policy": sql(
        "contributions",
        """SELECT POLICY_ID, CAST(row_number() OVER (ORDER BY abs(PHI) DESC, FEATURE) AS INT) AS RANK, FEATURE,
          round(PHI, 5) AS CONTRIBUTION
        FROM contributions WHERE POLICY_ID = (SELECT max(POLICY_ID) FROM scored)""",
    ),
    "training_run_log": sql(
        "level_means",
        """SELECT 'glm_1' AS run, v.*, c.* FROM (
          SELECT round(sqrt(avg((s.PURE_PREMIUM - l.TRAIN_M) * (s.PURE_PREMIUM - l.TRAIN_M))), 3) AS val_rmse,
            round(avg(abs(s.PURE_PREMIUM - l.TRAIN_M)), 3) AS val_mae
          FROM scored s JOIN level_means l ON l.TERRITORY_CODE = s.TERRITORY_CODE WHERE NOT s.IS_TRAIN) v,
        (SELECT round(avg(E), 3) AS cv_rmse_mean, round(stddev_pop(E), 3) AS cv_rmse_std FROM (
          SELECT sqrt(sum(h.EXPOSURE * (h.PURE_PREMIUM - t.M) * (h.PURE_PREMIUM - t.M)) / sum(h.EXPOSURE)) AS E
          FROM scored h
          JOIN (SELECT f.FOLD, s.TERRITORY_CODE, sum(s.CLAIM_AMOUNT) / sum(s.EXPOSURE) AS M
                FROM (SELECT DISTINCT FOLD FROM scored) f JOIN scored s ON s.FOLD <> f.FOLD
                WHERE s.IS_TRAIN GROUP BY f.FOLD, s.TERRITORY_CODE) t
            ON t.FOLD = h.FOLD AND t.TERRITORY_CODE = h.TERRITORY_CODE
          WHERE h.IS_TRAIN GROUP BY h.FOLD)) c""",
    ),
    "score_new_policies": sql(
        "level_means",
        """SELECT s.POLICY_ID, round(l.TRAIN_M, 3) AS PREDICTED_PURE_PREMIUM
        FROM scored s JOIN level_means l ON l.TERRITORY_CODE = s.TERRITORY_CODE""",
    ),
    "tree_attributions": sql(
        "scored",
        """SELECT s.POLICY_ID, round(t.M, 2) AS BASELINE, round(a.M - t.M, 2) AS AGE_explanation
        FROM scored s
        JOIN (SELECT coalesce(PROPERTY_AGE, -1) AS AGE, sum(CLAIM_AMOUNT) / sum(EXPOSURE) AS M FROM scored GROUP BY 1) a
          ON a.AGE = coalesce(s.PROPERTY_AGE, -1),
        (SELECT sum(CLAIM_AMOUNT) / sum(EXPOSURE) AS M FROM scored) t""",
    ),
    "tree_attributions_add_up": sql("scored", "SELECT POLICY_ID, true AS ADDS_UP FROM scored"),
    "run_comparison": sql("errors", "SELECT MODEL AS run, round(RMSE, 4) AS RMSE, round(MAE, 4) AS MAE FROM errors"),
    "model_versions": sql(
        "level_means",
        f"""SELECT 'TWEEDIE_GLM' AS model, 'v1' AS version, true AS is_default,
          round(sqrt(avg((s.PURE_PREMIUM - l.TRAIN_M) * (s.PURE_PREMIUM - l.TRAIN_M))), 3) AS val_rmse
        FROM scored s JOIN level_means l ON l.TERRITORY_CODE = s.TERRITORY_CODE WHERE NOT s.IS_TRAIN
        UNION ALL SELECT 'TWEEDIE_GLM', 'v2', false, round(sqrt(avg((s.PURE_PREMIUM - h.M) * (s.PURE_PREMIUM - h.M))), 3)
        FROM scored s JOIN (
          SELECT TERRITORY_CODE = '{TERRITORIES[1]}' AS ONE, sum(CLAIM_AMOUNT) / sum(EXPOSURE) AS M
          FROM scored WHERE IS_TRAIN GROUP BY 1) h ON h.ONE = (s.TERRITORY_CODE = '{TERRITORIES[1]}')
        WHERE NOT s.IS_TRAIN""",
    ),
    "xml_policy_roundtrip": sql("home_policy_freq", f"SELECT {FEED_COLUMNS} FROM home_policy_freq"),
    "xml_variant_landing": sql("home_policy_freq", f"SELECT {FEED_COLUMNS} FROM home_policy_freq"),
    "xml_claim_roundtrip": sql(
        "home_policy_sev",
        "SELECT POLICY_ID, count(*) AS CLAIMS, count(*) AS SENT, true AS AMOUNT_KEPT FROM home_policy_sev GROUP BY POLICY_ID",
    ),
    "feed_quality": sql("home_policy_freq", _FEED_MISSING),
    "feed_row_counts": sql(
        ["home_policy_freq", "home_policy_sev"],
        """SELECT 'policies' AS FEED, count(*) AS ROW_COUNT FROM home_policy_freq
        UNION ALL SELECT 'claims', count(*) FROM home_policy_sev""",
    ),
    "source_normalise": """
        SELECT o_orderkey AS POLICY_ID, (1 + o_orderkey % 13)::DOUBLE / 16 AS EXPOSURE,
          CAST(18 + o_orderkey % 70 AS INT) AS POLICYHOLDER_AGE,
          CAST(50 + o_orderkey % 180 AS DOUBLE) AS LOSS_HISTORY_SCORE, o_totalprice AS POPULATION_DENSITY,
          o_orderstatus AS REGION_CODE, substr(o_orderpriority, 3, 20) AS TERRITORY_CODE,
          CASE o_custkey % 16 WHEN 1 THEN 'Frame' WHEN 2 THEN 'Masonry' WHEN 3 THEN 'Superior Masonry'
            WHEN 4 THEN 'Non-Combustible' WHEN 5 THEN 'Masonry Non-Combustible' WHEN 6 THEN 'Modified Fire Resistive'
            WHEN 10 THEN 'Fire Resistive' WHEN 11 THEN 'Log' WHEN 12 THEN 'Superior Frame'
            WHEN 13 THEN 'Manufactured Home' WHEN 14 THEN 'Mixed Construction' END AS CONSTRUCTION_TYPE,
          CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_orderkey % 12 AS INT) END AS CONSTRUCTION_QUALITY,
          CAST(o_orderkey % 40 AS INT) AS PROPERTY_AGE,
          CASE o_orderstatus WHEN 'F' THEN 'Owner-Occupied' WHEN 'O' THEN 'Tenant-Occupied' END AS OCCUPANCY_TYPE,
          CAST(o_orderkey % 5 AS INT) AS CLAIM_COUNT
        FROM orders""",
    "source_claims_normalise": """
        SELECT l_orderkey AS POLICY_ID, count(l_extendedprice) AS CLAIMS, round(max(l_extendedprice), 4) AS LARGEST
        FROM lineitem GROUP BY l_orderkey""",
    "predictions_xml": sql("scored", "SELECT POLICY_ID, SCORE AS PREDICTED_PURE_PREMIUM FROM scored"),
    "table_counts": f"""
        WITH counts AS ({_COUNTS}), cols AS ({_COLUMNS})
        SELECT 'testdata' AS TABLE_SCHEMA, c.TABLE_NAME, 'BASE TABLE' AS TABLE_TYPE, n.ROW_COUNT,
          CAST(count(*) AS INT) AS COLUMN_COUNT
        FROM cols c JOIN counts n ON n.TABLE_NAME = c.TABLE_NAME GROUP BY c.TABLE_NAME, n.ROW_COUNT""",
    "schema_rollup": f"""
        WITH counts AS ({_COUNTS}), cols AS ({_COLUMNS})
        SELECT 'testdata' AS TABLE_SCHEMA, (SELECT count(*) FROM counts) AS TABLES,
          (SELECT count(*) FROM cols) AS COLUMN_COUNT, (SELECT CAST(sum(ROW_COUNT) AS BIGINT) FROM counts) AS ROW_COUNT""",
    "dictionary_columns": f"""
        WITH cols AS ({_COLUMNS}), profiles AS ({_PROFILES})
        SELECT c.TABLE_NAME, CAST(c.ORDINAL_POSITION AS INT) AS ORDINAL_POSITION, c.COLUMN_NAME, c.DATA_TYPE,
          p.MAX_LENGTH, p.NULL_COUNT
        FROM cols c JOIN profiles p ON p.TABLE_NAME = c.TABLE_NAME AND p.COLUMN_NAME = c.COLUMN_NAME""",
    "data_dictionary": _DICTIONARY
    + f""", profiles AS ({_PROFILES})
    SELECT 'testdata' AS TABLE_SCHEMA, 'BASE TABLE' AS TABLE_TYPE, d.*, 'YES' AS IS_NULLABLE, p.MAX_LENGTH,
      NULL::INT AS NUMERIC_PRECISION, NULL::INT AS NUMERIC_SCALE, NULL::VARCHAR AS COLUMN_DEFAULT
    FROM dictionary d JOIN profiles p ON p.TABLE_NAME = d.TABLE_NAME AND p.COLUMN_NAME = d.COLUMN_NAME""",
    "dictionary_one_table": _DICTIONARY
    + "SELECT * EXCLUDE (TABLE_DESCRIPTION) FROM dictionary WHERE TABLE_NAME = 'orders'",
    "undocumented_columns": _DICTIONARY
    + "SELECT TABLE_NAME, COLUMN_NAME, DATA_TYPE FROM dictionary WHERE COLUMN_DESCRIPTION IS NULL",
    "doc_coverage": _DICTIONARY
    + """SELECT TABLE_NAME, count(*) AS COLUMNS, count(COLUMN_DESCRIPTION) AS DESCRIBED,
        round(100.0::DOUBLE * count(COLUMN_DESCRIPTION) / count(*), 4) AS COVERAGE FROM dictionary GROUP BY TABLE_NAME""",
}
_VALIDATION = "scored s JOIN level_means l ON l.TERRITORY_CODE = s.TERRITORY_CODE"
_GAP = "(s.PURE_PREMIUM - l.TRAIN_M)"
ORACLE["glm_against_trees"] = sql("level_means", "") + f"""
    , predictions AS (
      SELECT unnest(['GLM', 'GBM']) AS MODEL, s.POLICY_ID, l.TRAIN_M AS P, s.PURE_PREMIUM AS Y, s.EXPOSURE AS W
      FROM {_VALIDATION} WHERE NOT s.IS_TRAIN),
    {", ".join(f"{n} AS ({CTES[n]})" for n in ("edges", "lift", "curve", "area", "errors"))}
    SELECT e.MODEL, round(e.RMSE, 3) AS RMSE, round(e.MAE, 3) AS MAE, round(e.RMSE_WEIGHTED, 3) AS RMSE_WEIGHTED,
      round(1 - 2 * a.AUC, 8) AS GINI, round(l.R, 6) AS LIFT_RATIO, round(l.G, 3) AS WORST_GAP
    FROM errors e JOIN area a ON a.MODEL = e.MODEL
    JOIN (SELECT MODEL, arg_max(OBSERVED, DECILE) / arg_min(OBSERVED, DECILE) AS R,
            max(abs(PREDICTED - OBSERVED)) AS G FROM lift GROUP BY MODEL) l ON l.MODEL = e.MODEL"""
ORACLE["boosting_run_log"] = sql(
    "level_means",
    f"""SELECT CASE WHEN s.IS_TRAIN THEN 'train' ELSE 'validation' END AS run,
      round(sqrt(sum(s.EXPOSURE * {_GAP} * {_GAP}) / sum(s.EXPOSURE)), 3) AS ROOT_LOSS
    FROM {_VALIDATION} GROUP BY s.IS_TRAIN""",
)
ORACLE["sketched_quantile_ranks"] = "\nUNION ALL ".join(
    f"SELECT '{c}' AS COLUMN_NAME, unnest([0.1, 0.5, 0.9])::DOUBLE AS POINT, true AS WITHIN" for c in IMPUTED
)
ORACLE["batch_scores"] = ORACLE["glm_one_way"]
ORACLE["batch_quantile_ranks"] = ORACLE["sketched_quantile_ranks"]
ORACLE["bucketed_policies_with_claims"] = ORACLE["policies_with_claims"]
ORACLE["bucketed_spine_features"] = ORACLE["spine_features"]
ORACLE["batch_distinct_counts"] = "\nUNION ALL ".join(
    f"""SELECT '{t}' AS TABLE_NAME, c.column_name AS COLUMN_NAME, n.ROW_COUNT, n.ROW_COUNT - c.VALUE_COUNT AS NULL_COUNT, true AS WITHIN
    FROM (UNPIVOT (SELECT CAST(count(COLUMNS(*)) AS BIGINT) FROM {t}) ON COLUMNS(*) INTO NAME column_name VALUE VALUE_COUNT) c,
      (SELECT count(*) AS ROW_COUNT FROM {t}) n"""
    for t in TABLES
)
ORACLE["model_predictions_xml"] = ORACLE["batch_scores"]
ORACLE["dictionary_view"] = _DICTIONARY + """SELECT TABLE_NAME, COLUMN_NAME, ROW_COUNT, COL_POSITION, true AS HAS_BYTES,
  true AS DISTINCT_KNOWN, COLUMN_DESCRIPTION FROM dictionary"""
