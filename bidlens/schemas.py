"""Column layouts of the headerless input files and of the packed queue entries."""

from __future__ import annotations

from dataclasses import dataclass

TRACK_LOG = (
    "request_id int, exposure_epoch bigint, user_id int, position_id smallint, ad_info string"
)
AD_STATIC = (
    "ad_id int, create_time bigint, ad_account_id int, item_id int, item_category int, "
    "industry_id int, ad_size_id int"
)
AD_OPERATION = "ad_id int, time string, operation int, object int, cost_mode int, bid double"
TEST_SAMPLE = "test_id bigint, ad_id int, object int, cost_mode int, bid double"
TEST_SELECT = "ad_id int, requestion_list string"

STATIC_KEYS = ["ad_account_id", "item_id", "item_category", "industry_id", "ad_size_id"]
SETTINGS = ["object", "cost_mode", "bid"]


@dataclass(frozen=True)
class QueueLayout:
    """Positions of the fields of a queue entry, counted from the end."""

    pctr: int
    q_ecpm: int
    total_ecpm: int
    filter_flag: int
    exposed: int | None = None

    @property
    def numeric(self) -> dict[str, int]:
        return {
            "pctr": self.pctr,
            "q_ecpm": self.q_ecpm,
            "total_ecpm": self.total_ecpm,
            "filter_flag": self.filter_flag,
        }


# Field offsets of training entries and of test entries, which
# lack the closing exposed flag.
TRAIN_ENTRY = QueueLayout(pctr=-5, q_ecpm=-4, total_ecpm=-3, filter_flag=-2, exposed=-1)
TEST_ENTRY = QueueLayout(pctr=-4, q_ecpm=-3, total_ecpm=-2, filter_flag=-1)
