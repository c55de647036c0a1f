from skymart.plans import alerts

AREA = "<area><areaDesc> {} </areaDesc>{}</area>"
RING = "<polygon>3.5,98.6 3.6,98.7\n 3.5,98.8</polygon>"


def item(title, link):
    return f"<item><title>{title}</title><link> {link} </link></item>"


def document(severity, *areas, info=True):
    body = f"<event>Hujan</event><headline>\n H {severity}</headline><severity>{severity}</severity>" + "".join(areas)
    return f"<alert><identifier>x</identifier>{'<info>' + body + '</info>' if info else body}</alert>"


def test_alerts(spark):
    feed = "<rss>" + "".join([
        item("Weather in the NORTH", "a"), item("Jawa", "b"), item("the north", "gone"),
        item("the north", "c"), "<item><title>the north</title></item>", item("The North", "d")]) + "</rss>"
    docs = [("a", document("Moderate", AREA.format("Satu", RING), AREA.format("Dua", RING + RING))),
            ("b", document("Extreme")), ("c", document("Severe", info=False)), ("d", document("Moderate"))]
    feeds = spark.createDataFrame([(1, feed)], "feed_id int, xml string")
    got = alerts.parse_alerts(feeds, spark.createDataFrame(docs, "link string, xml string"), "north")
    rows = got.orderBy("position").collect()
    assert [(r.link, r.severity, len(r.areas)) for r in rows] == [("a", "Moderate", 2), ("c", "Severe", 0), ("d", "Moderate", 0)]
    assert rows[0].headline == "H Moderate" and rows[0].urgency == ""
    assert rows[0].areas[0].areaDesc == "Satu"
    assert rows[0].areas[0].polygons == [[[98.6, 3.5], [98.7, 3.6], [98.8, 3.5]]]
    assert alerts.top_alert(got).first().link == "c"
    flat = alerts.alert_polygons(got).collect()
    assert [(r.areaDesc, r.area_position, r.polygon_position) for r in flat] == [("Satu", 0, 0), ("Dua", 1, 0), ("Dua", 1, 1)]


def test_unknown_severity_comes_first(spark):
    rows = [(1, i, s, s) for i, s in enumerate(["Extreme", "Minor", "?", "Odd"])]
    df = spark.createDataFrame(rows, "feed_id int, position int, severity string, link string")
    assert alerts.top_alert(df).first().link == "?"
