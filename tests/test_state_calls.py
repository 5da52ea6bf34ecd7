"""Detectors send Python few columns, and call the state store once to read and once to write."""

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from packwatch.streaming import detectors


class State:
    def __init__(self):
        self.value, self.calls = None, []

    def exists(self):
        self.calls.append("exists")
        return self.value is not None

    def get(self):
        self.calls.append("get")
        return self.value

    def update(self, value):
        self.calls.append("update")
        self.value = value

    put = update


class Handle:
    def __init__(self):
        self.state = State()

    def getValueState(self, name, schema):
        return self.state

    getListState = getValueState

    def registerTimer(self, at):
        pass


class Timers:
    def getCurrentWatermarkInMs(self):
        return 0


@pytest.mark.parametrize(
    ("processor", "text"),
    [(detectors.SessionProcessor(), "5 true - 1.5"), (detectors.PatternProcessor(), "5000 -1 true false")],
    ids=["session", "pattern"],
)
def test_one_call_to_read_and_one_to_write(processor, text):
    handle = Handle()
    processor.init(handle)
    assert list(processor.handleInputRows(("v",), iter([Row(vin="v", row=text)]), Timers())) == []
    assert handle.state.calls == ["get", "update"]


def test_rows_travel_as_one_column(spark):
    rows = [("v", 7, None, 0.1 + 0.2, "1"), ("v", -8, -1, None, "0"), ("v", 9, 2, -1.5e300, None)]
    frame = spark.createDataFrame(rows, "vin string, msg_us long, frame_id long, soc_pct double, s string")
    sent = detectors.session_input(frame, F.col("s") == "1", None, 0)
    assert sent.columns == ["vin", "row"]
    back = {detectors.unpacked(r.row, int, detectors.is_true, int, float) for r in sent.collect()}
    assert back == {(7, True, None, 0.1 + 0.2), (-8, False, -1, None), (9, False, 2, -1.5e300)}
