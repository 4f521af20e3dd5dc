"""R32-R34 over all slots that the rows have, current and past."""

import pytest
from test_rules import fired

from tallyward.operators import catalog


def test_special_names_and_dates_in_late_and_past_slots(spark):
    columns = {
        "chrpharm_med11_name": ["573", "5", "5"], "chrpharm_med2_name_past": ["5", "542", "5"],
        "chrpharm_med11_onset": ["", "", "2024-02-02"], "chrpharm_med11_offset": ["", "", "2024-02-01"],
        "chrpharm_med50_onset_past": ["2024-02-02", "", ""], "chrpharm_med50_offset_past": ["2024-02-01", "", ""],
    }
    made = catalog.medication_rules(list(columns))
    assert fired(spark, made, **columns) == [{"medication 11", "onset 50_past"}, {"medication 2_past"}, {"onset 11"}]


@pytest.mark.parametrize("past", ["", "_past"])
@pytest.mark.parametrize("field", ["med11_use", "med11_comp", "med11_mo11", "interm_meds", "med11_onset", "med11_offset", "med11_dosage"])
def test_unknown_names_with_any_field_filled(spark, past, field):
    columns = {f"chrpharm_med11_name{past}": ["888", "888", "5"], f"chrpharm_{field}{past}": ["5", "", "5"]}
    rule = "unknown past medication" if past else "unknown medication"
    assert fired(spark, catalog.unknown_names(list(columns)), **columns) == [{rule}, set(), set()]
