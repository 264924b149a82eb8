from .columns import (  # noqa: F401
    DUMMY_COLUMNS, channel_dummies, channel_group, clv_level_abs, day_diff,
    dummy_name, floor_days, mismatch, money, r6, rfm_code, segment_name, ts_literal,
)
