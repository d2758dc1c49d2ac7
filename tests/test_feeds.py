import gzip

import pytest
from pyspark.sql import functions as F

from ratewright.sources import feeds
from ratewright.sources.adapter import policy_freq, policy_sev

POLICY = """  <Policy>
    <PolicyId>{id}</PolicyId><Exposure>0.5</Exposure><PolicyholderAge>40</PolicyholderAge>
    <LossHistoryScore>101.25</LossHistoryScore><PopulationDensity>12.5</PopulationDensity>
    <RegionCode>{region}</RegionCode>
    {risk}
    <Claims><ClaimCount>1</ClaimCount></Claims>
  </Policy>
"""
RISK = (
    "<Risk><TerritoryCode>007</TerritoryCode><ConstructionType>Frame</ConstructionType>"
    "<ConstructionQuality>3</ConstructionQuality><PropertyAge>{age}</PropertyAge>"
    "<OccupancyType>Owner-Occupied</OccupancyType></Risk>"
)


@pytest.fixture
def inbound(tmp_path):
    policies = [
        POLICY.format(id=1, region="R1", risk=RISK.format(age=10)),
        POLICY.format(id=2, region="Up &amp; &lt;down&gt;", risk=RISK.format(age="old")),
        POLICY.format(id=3, region="R3", risk="<Risk/>"),
        POLICY.format(id=4, region="R4", risk=""),
        POLICY.format(id=4, region="R4", risk=RISK.format(age=" 7 ")),
    ]
    with gzip.open(tmp_path / "x_policy_freq.xml.gz", "wt") as f:
        f.write("<PolicyFeed>\n" + "".join(policies) + "</PolicyFeed>")
    claims = "<ClaimFeed><Claim><PolicyId>1</PolicyId><ClaimAmount>12.30</ClaimAmount></Claim></ClaimFeed>"
    (tmp_path / "x_policy_sev.xml").write_text(claims)
    return str(tmp_path)


def test_edges_of_the_policy_feed(spark, inbound):
    rows = feeds.read_policy_feed(spark, inbound, feeds.POLICY_PATTERN).orderBy("POLICY_ID", "PROPERTY_AGE").collect()
    assert [r["POLICY_ID"] for r in rows] == [1, 2, 3, 4, 4]
    assert rows[0]["TERRITORY_CODE"] == "007" and rows[0]["PROPERTY_AGE"] == 10
    assert rows[1]["REGION_CODE"] == "Up & <down>" and rows[1]["PROPERTY_AGE"] is None
    assert rows[1]["CONSTRUCTION_QUALITY"] == 3  # one bad leaf leaves its neighbours alone
    assert rows[2]["TERRITORY_CODE"] is None and rows[2]["CLAIM_COUNT"] == 1
    assert rows[4]["PROPERTY_AGE"] == 7
    assert [n for n, _ in feeds.read_policy_feed(spark, inbound, feeds.POLICY_PATTERN).dtypes] == [
        c for c, _, _ in feeds.POLICY_FIELDS
    ]


def test_quality_counts_missing_and_rejected(spark, inbound):
    found = {r["COLUMN_NAME"]: r for r in feeds.feed_quality(spark, inbound, pattern=feeds.POLICY_PATTERN).collect()}
    assert found["PROPERTY_AGE"].asDict() == {
        "COLUMN_NAME": "PROPERTY_AGE", "FEED_ROWS": 5, "MISSING": 2, "REJECTED": 1,
    }
    assert found["POLICY_ID"]["MISSING"] == found["POLICY_ID"]["REJECTED"] == 0


def test_name_pattern_separates_the_feeds(spark, inbound):
    claims = feeds.read_claim_feed(spark, inbound, feeds.CLAIM_PATTERN).collect()
    assert [tuple(r) for r in claims] == [(1, 12.3)]


def test_variant_landing(spark, inbound):
    landed = feeds.land_feed(spark, inbound, feeds.POLICY_FEED, feeds.POLICY_PATTERN)
    assert dict(landed.dtypes) == {"SRC": "variant"} and landed.count() == 5
    rows = feeds.extract_fields(landed).orderBy("POLICY_ID").collect()
    assert rows[1]["PROPERTY_AGE"] is None and rows[1]["CONSTRUCTION_QUALITY"] == 3
    assert rows[0]["EXPOSURE"] == 0.5 and rows[2]["TERRITORY_CODE"] is None
    assert rows[0]["TERRITORY_CODE"] == "007"  # a code stays the text it is
    typed = feeds.read_policy_feed(spark, inbound, feeds.POLICY_PATTERN).orderBy("POLICY_ID").collect()
    assert rows == typed


def test_empty_feed(spark, tmp_path):
    (tmp_path / "a_policy_freq.xml").write_text("<PolicyFeed></PolicyFeed>")
    assert feeds.read_policy_feed(spark, str(tmp_path), feeds.POLICY_PATTERN).count() == 0


def test_round_trip_through_several_gzip_parts(spark, sf_dir, tmp_path):
    freq = policy_freq(spark, sf_dir).withColumn("REGION_CODE", F.concat("REGION_CODE", F.lit(" <&> 'x'")))
    path = str(tmp_path / "home_policy_freq.xml")
    feeds.write_policy_feed(freq.repartition(3), path, rows_per_file=200)
    files = [f for f in (tmp_path / "home_policy_freq.xml").iterdir() if f.name.endswith(".xml.gz")]
    assert len(files) >= 8
    with gzip.open(files[0], "rt") as f:
        text = f.read()
    assert text.lstrip().startswith("<PolicyFeed>") and text.rstrip().endswith("</PolicyFeed>")
    assert "<Risk>" in text and "null" not in text
    back = feeds.read_policy_feed(spark, str(tmp_path), feeds.POLICY_PATTERN)
    sent = freq.withColumns({c: F.round(c, n) for c, n in feeds.FEED_DECIMALS.items() if c in freq.columns})
    sent = sent.select(*back.columns)
    assert sent.exceptAll(back).count() == 0 and back.exceptAll(sent).count() == 0


def test_reload_replaces_and_keeps_the_inputs(spark, inbound, tmp_path):
    targets = [str(tmp_path / "p"), str(tmp_path / "c")]
    expected = {"policies": {"rows": 5, "without_key": 0}, "claims": {"rows": 1, "without_key": 0}}
    assert feeds.load_feeds(spark, inbound, *targets) == expected
    assert feeds.load_feeds(spark, inbound, *targets) == expected
    assert spark.read.parquet(targets[0]).count() == 5
    assert (tmp_path / "x_policy_freq.xml.gz").exists()


def test_normalising_unknown_and_quoted_codes(spark):
    raw = spark.createDataFrame(
        [("7", "2", "0.5", "'A'", "5", "x", "30", "90", "'B12'", "'Regular'", "10", "''R1'"),
         ("8", "0", "1", "B", "6", "1", "31", "91", "B7", "Gas", "11", "R2")],
        list(feeds.POLICY_COLUMNS),
    )
    first, second = feeds.normalise_policies(raw).orderBy("POLICY_ID").collect()
    assert first["CONSTRUCTION_TYPE"] == "Superior Frame" and first["OCCUPANCY_TYPE"] == "Owner-Occupied"
    assert first["TERRITORY_CODE"] == "A" and first["REGION_CODE"] == "R1" and first["PROPERTY_AGE"] is None
    assert second["CONSTRUCTION_TYPE"] is None and second["OCCUPANCY_TYPE"] is None and second["EXPOSURE"] == 1.0


def test_claims_of_one_policy_all_arrive(spark, sf_dir, tmp_path):
    sev = policy_sev(spark, sf_dir)
    feeds.write_claim_feed(sev, str(tmp_path / "home_policy_sev.xml"))
    back = feeds.read_claim_feed(spark, str(tmp_path), feeds.CLAIM_PATTERN)
    assert back.count() == sev.count()
    gap = abs(back.agg(F.sum("CLAIM_AMOUNT")).first()[0] - sev.agg(F.sum("CLAIM_AMOUNT")).first()[0])
    assert gap < 0.005 * back.count()


def test_what_no_field_lists_survives_landing(spark, tmp_path):
    (tmp_path / "a_policy_freq.xml").write_text(
        '<PolicyFeed><Policy id="9"><PolicyId>007</PolicyId><RoofType>Tile</RoofType><Risk><TerritoryCode>A</TerritoryCode>'
        "<Sprinkler>1</Sprinkler></Risk><Tag>x</Tag><Tag>2</Tag></Policy><Policy><PolicyId>8</PolicyId><Tag>z</Tag>"
        "<Risk><Deep><Level>0.5</Level></Deep></Risk><Built>2020-01-02</Built></Policy></PolicyFeed>"
    )
    landed = feeds.land_feed(spark, str(tmp_path), feeds.POLICY_FEED, feeds.POLICY_PATTERN)
    found = {r["PATH"]: (r["ROWS"], r["LEAVES"], r["TYPE"]) for r in feeds.feed_unknown_paths(landed).collect()}
    assert found == {
        "RoofType": (1, 1, "string"), "Risk.Sprinkler": (1, 1, "bigint"), "Tag[]": (2, 3, "string"), "_id": (1, 1, "bigint"),
        "Risk.Deep.Level": (1, 1, "double"), "Built": (1, 1, "date"),
    }
    assert feeds.feed_paths(landed).where("PATH = 'PolicyId'").first()["ROWS"] == 2
    rows = feeds.extract_fields(landed).orderBy("POLICY_ID").collect()
    assert rows == feeds.read_policy_feed(spark, str(tmp_path), feeds.POLICY_PATTERN).orderBy("POLICY_ID").collect()
    from pyspark.sql import functions as F

    text = landed.select(F.try_variant_get("SRC", "$.PolicyId", "string").alias("t")).collect()
    assert {r["t"] for r in text} == {"007", "8"}


def test_landing_an_empty_feed(spark, tmp_path):
    (tmp_path / "a_policy_freq.xml").write_text("<PolicyFeed></PolicyFeed>")
    landed = feeds.land_feed(spark, str(tmp_path), feeds.POLICY_FEED, feeds.POLICY_PATTERN)
    assert landed.count() == 0 and feeds.feed_unknown_paths(landed).collect() == []


def test_listed_leaves_are_left_out_before_they_are_stored(spark, monkeypatch):
    landed = spark.createDataFrame(
        [('{"PolicyId": "7", "RegionCode": {"Old": "R1"}, "Risk": {"TerritoryCode": "A", "Sprinkler": "1"}, "Tag": ["x", "2"]}',)],
        "text string",
    ).select(F.parse_json("text").alias("SRC"))
    kept = []

    def materialise(df, label):
        kept.extend(r["path"] for r in df.select("path").collect())
        return real(df, label)

    real = feeds.materialise
    monkeypatch.setattr(feeds, "materialise", materialise)
    found = {r["PATH"]: (r["ROWS"], r["LEAVES"], r["TYPE"]) for r in feeds.feed_unknown_paths(landed).collect()}
    assert found == {
        "RegionCode.Old": (1, 1, "string"), "Risk.Sprinkler": (1, 1, "bigint"), "Tag[]": (1, 2, "string"),
    }
    assert "PolicyId" not in kept and "Risk.TerritoryCode" not in kept and "RegionCode.Old" in kept


@pytest.mark.parametrize("kind", feeds.LEAF_TYPES)
def test_no_value_is_missed_before_the_cast(spark, kind):
    texts = """1 -1 +5 +.5 1. .5 0 007 1e5 1d 0x1 -0 9223372036854775807 9223372036854775808 1_0 2020-01-02 2020 R3 true FALSE t F y
        Yes n No 1true on off . - + 12:30""".split() + [" 1", "2\n", "\t3\t", "\x0b4", "\u00855", " true ", "\nNO\t", "\x01f", "", " ", "1 2"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    plain, guarded = F.col("t").try_cast(kind), feeds._parsed(F.col("t"), kind)
    assert rows.where(~F.equal_null(plain, guarded)).collect() == []
    assert rows.where(plain.isNotNull()).count() >= 2
    if kind in feeds.LIKE:
        assert rows.where(F.col("t").isin("R3", "2020-01-02", "12:30") & F.col("t").rlike(feeds.LIKE[kind])).count() == 0
