"""Hand fixtures for the feed parsers (FIXTURES.md section 4)."""

from conftest import lines_df

from learnstream.sources import parse

T = "2019-07-16 16:01:55"


def test_register_width_filter_and_channels(spark):
    lines = [
        f"1\t1\t{T}",          # exact -> PC
        "2\t1",                # one short
        f"3\t1\t{T}\tx",       # one long
        "4\t1\t",              # trailing empty: Java split drops it -> 2 fields
        f"5\t\t{T}",           # inner empty: kept, Other
        "",                    # empty line
        "\t\t\t",              # tabs only
        f"6\t1\t{T}\t",        # trailing tab after 3 fields: still 3
        f"7\t2\t{T}", f"8\t3\t{T}", f"9\t0\t{T}", f"10\tabc\t{T}",
    ]
    got = {r.uid: r.channel for r in parse.parse_register(lines_df(spark, lines)).collect()}
    assert got == {1: "PC", 5: "Other", 6: "PC", 7: "APP", 8: "Other", 9: "Other", 10: "Other"}


def test_qz_rejects_non_numeric_keys(spark):
    lines = [f"1004\t501\t14\t5\t1\t{T}", f"x\t501\t14\t5\t1\t{T}", "1004\t501",
             f"1004\t501\t10\t5\t1\t"]
    df = parse.parse_qz(lines_df(spark, lines))
    assert [tuple(r) for r in df.collect()] == [(1004, 501, 14, "5", "1", T)]
    flagged = parse.parse_qz(lines_df(spark, lines), keep_rejects=True)
    assert sorted(r.valid for r in flagged.collect()) == [False, False, False, True]


def test_page_json_cases(spark):
    lines = ["not json", "[1]", "", '{"uid":"7"} x', '{"uid":"7"},{"uid":"8"}', "null", '{"uid":"7","page_id":2}', '{"uid":null,"page_id":"1"}',
             '{"uid":"1","app_id":"1","device_id":"3","ip":"10.1.2.1","last_page_id":"1",'
             '"page_id":"2","next_page_id":"3"}']
    rows = [r.asDict() for r in parse.parse_page(lines_df(spark, lines)).collect()]
    assert len(rows) == 3
    assert {"uid": "7", "app_id": "", "device_id": "", "ip": "", "last_page_id": "",
            "page_id": "2", "next_page_id": ""} in rows          # number rendered as text
    assert any(r["uid"] == "" and r["page_id"] == "1" for r in rows)  # explicit null -> ''


def test_learn_defaults_and_seconds(spark):
    base = '"uid":1,"cwareid":2,"videoid":3,"chapterid":4,"subjectid":5,"sourceType":"PC","speed":1,"ps":0,"pe":10'
    lines = ["{" + base + ',"ts":0,"te":0}', "{" + base + ',"ts":0,"te":999}',
             "{" + base + ',"ts":0,"te":1000}', "{" + base + ',"ts":2000,"te":500}',
             "{" + base + "}", "not json", "[]"]
    rows = parse.parse_learn(lines_df(spark, lines)).collect()
    assert [r.secs for r in rows] == [0, 0, 1, -1]        # toward zero
    assert all(r.edutypeid == 0 for r in rows)            # absent int -> 0


def test_replay_spreads_lines_over_ten_partitions(spark, tmp_path):
    from learnstream.sources.feeds import replay_frame, replay_to_dir
    lines = lines_df(spark, [f"{i}\t1\t{T}" for i in range(50)]).coalesce(1)
    out = replay_frame(lines, 10)
    assert out.rdd.getNumPartitions() >= 10 and out.count() == 50
    replay_to_dir(lines, str(tmp_path / "feed"))
    back = spark.read.text(str(tmp_path / "feed"))
    assert sorted(r.value for r in back.collect()) == sorted(r.value for r in lines.collect())


def test_learn_numbers_as_text_and_decimals(spark):
    lines = ['{"uid":"7","ts":"0","te":"2000","ps":0.5,"pe":"9.9"}', '{"uid":"x","ts":1,"te":2,"speed":null}',
             '{"uid":7,"ts":"x","te":2}', '{"uid":7,"ts":1,"te":2} {"uid":8}']
    flagged = parse.parse_learn(lines_df(spark, lines), keep_rejects=True).collect()
    assert [r.valid for r in flagged] == [True, True, False, False]
    rows = parse.parse_learn(lines_df(spark, lines)).collect()
    assert [(r.uid, r.secs, r.ps, r.pe, r.speed) for r in rows] == [(7, 2, 0, 9, 0), (0, 0, 0, 0, 0)]
    few = parse.parse_learn(lines_df(spark, lines), columns=["uid", "secs"])
    assert [tuple(r) for r in few.collect()] == [(7, 2), (0, 0)]


def test_rejects_are_flagged_in_every_parser(spark):
    page = parse.parse_page(lines_df(spark, ['{"page_id":"1"}', "x"]), keep_rejects=True)
    assert [r.valid for r in page.collect()] == [True, False]
    reg = parse.parse_register(lines_df(spark, [f"1\t1\t{T}", "1"]), keep_rejects=True)
    assert [r.valid for r in reg.collect()] == [True, False]


def test_text_behind_an_object_is_never_dropped(spark):
    good = ['{"uid":"1"}', ' {"uid":"2"} ', '{"uid":"3","_end":"2"}', '{"uid":"4","x":{"_end":"1"}}']
    bad = ['{"uid":"1"}] junk', '{"uid":"2"}]', '{"uid":"1"},{"_end":"1"}', '{"uid":"1"},', '{"uid":"1"}]]', '{"uid":"1"',
           '{"uid":"1"},{"_end":"1"}] x', ',{"uid":"1"}', '{"uid":"1"} {"uid":"2"}', '[{"uid":"1"}]', '"x"', '1', '{', '}']
    flagged = parse.parse_page(lines_df(spark, good + bad), keep_rejects=True).collect()
    assert {r.line: r.valid for r in flagged} == dict.fromkeys(good, True) | dict.fromkeys(bad, False)
    learn = [x[:-1] + ',"ts":0,"te":1}' for x in good[:1]] + bad
    assert [r.valid for r in parse.parse_learn(lines_df(spark, learn), keep_rejects=True).collect()] == [
        True] + [False] * len(bad)


HOSTILE = ['"ts":-9223372036854775808,"te":9223372036854775807', '"ts":0,"te":1e300', '"ts":"-1","te":5',
           '"ts":0,"te":253402300800000', '"ts":0,"te":5,"ps":-2147483648,"pe":2147483647', '"ts":0,"te":5,"pe":1e12',
           '"ts":0,"te":5,"uid":99999999999', '"ts":0,"te":5,"speed":"1e400"', '"ts":0,"te":5,"pe":1000000001']


def test_numbers_beyond_their_bounds_cost_their_record(spark):
    from learnstream.operators import watch
    good = ['{"uid":1,"ts":0,"te":253402300799999,"ps":-1000000000,"pe":1000000000}', '{"uid":1,"ts":1,"te":"NaN"}',
            '{"uid":"NaN","ts":0,"te":5000,"pe":7.9}']
    lines = lines_df(spark, good + ["{%s}" % x for x in HOSTILE])
    flagged = parse.parse_learn(lines, keep_rejects=True).collect()
    assert [r.valid for r in flagged] == [True, False, True] + [False] * len(HOSTILE)
    # whichever columns a query needs
    assert parse.parse_learn(lines, columns=["chapterid", "secs"]).count() == 2
    assert watch.watch_detail(parse.parse_learn(lines)).count() == 2
    assert sorted(r.value for r in parse.rejected(lines, "course_learn").collect()) == sorted(
        good[1:2] + ["{%s}" % x for x in HOSTILE])
