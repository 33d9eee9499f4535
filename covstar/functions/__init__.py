"""Scalar ``Column`` expressions of the coverage model (no Python UDFs)."""

from .classify import (altitude_band, class_color, class_id_of, day_part, heat_weight,
                       mean_signal_color, signal_class, signal_class_id, weekend_flag)
from .geo import (cell_bounds, density_label, density_zone_name, grid_cell, kmh, sector_id,
                  with_cell_bounds, zone_name)
from .normalize import device_key, network_generation, normalize_network, normalize_operator
from .timekeys import (calendar_columns, date_key, day_name, hour_label, month_name, parse_hour,
                       parse_ts, reference_partition, ts_literal, week_partition, with_time_keys)

__all__ = [
    "altitude_band", "class_color", "class_id_of", "day_part", "heat_weight",
    "mean_signal_color", "signal_class", "signal_class_id", "weekend_flag",
    "cell_bounds", "density_label", "density_zone_name", "grid_cell", "kmh", "sector_id",
    "with_cell_bounds", "zone_name",
    "device_key", "network_generation", "normalize_network", "normalize_operator",
    "calendar_columns", "date_key", "day_name", "hour_label", "month_name", "parse_hour",
    "parse_ts", "reference_partition", "ts_literal", "week_partition", "with_time_keys",
]
