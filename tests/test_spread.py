from queryset.streams import _application, _lookups
from queryset.views import as_lines, signal_stream

SF = "/root/testdata/sf0.001"


def test_lines_of_one_file_are_parsed_by_all_tasks(spark):
    lines = as_lines(signal_stream(spark, SF))
    plan = _application().messages_stream({"feed": lines}, _lookups(spark, SF))._jdf.queryExecution().analyzed().toString()
    assert "RepartitionByExpression [seq" in plan
