"""Publication blockers and events that pages embed, on small frames."""

import datetime

from lodestar.operators import events, publication

GATE = "status string, review_required int, group_conflicts int, unresolved_groups int, guardrails_unmerged boolean"


def test_blockers(spark):
    rows = lambda *v: [r.blocker for r in publication.blockers(spark.createDataFrame([v], GATE)).collect()]
    assert rows("ready_machine_safe", 0, None, 0, None) == []
    assert rows(None, 2, 1, 3, False) == ["publication_gate_not_ready", "heuristic_review_required", "group_conflicts_present", "unresolved_multi_listing_entities_present", "guardrail_pair_merged"]


def test_embedded_events_nested_repeated_and_broken(spark):
    item = '{"EventId": 7, "Title": "Call", "StartDate": "2024-03-01T10:00:00", "PresentationLink": "/p", "Attachments": [{"Url": "/a"}, "/b", null]}'
    pages = [
        (1, f"<h1>Events</h1><script>x = {{bad; y = {{\"a\": [{item}, [{item}]]}};</script><SCRIPT>z = [{{'no': 1}}]</SCRIPT>"),
        (2, '<h3> Annual <b>meeting</b></h3> on 2024-05-02 <script>{"EventId": "q"}</script>'),
        (3, "<p>2024-05-02</p>"), (4, None), (5, ""), (6, '<script>{"EventTitle": "T", "StartDate": "soon"}</script>'),
    ]
    found = events.embedded_events(spark.createDataFrame(pages, "page_id int, html string")).orderBy("page_id").collect()
    assert [(r.page_id, r.title, r.confidence) for r in found] == [(1, "Call", "high"), (2, "Annual meeting", "low"), (6, "T", "high")]
    first, second, last = found
    assert (first.provider_event_id, first.starts_at, first.presentation_url, first.attachment_urls) == ("7", datetime.datetime(2024, 3, 1, 10), "/p", ["/a", "/b"])
    assert second.starts_at == datetime.datetime(2024, 5, 2) and second.attachment_urls is None
    assert last.starts_at is None
