"""Schemas of the tables that cross file boundaries."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


_S, _D, _I, _L = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType()

# Station codes are text: some of them consist of digits only.
DETECTION_CSV = _schema(
    ("event_id", _S), ("template_id", _S), ("origin_time", _S), ("station", _S),
    ("travel_time_p", _D), ("travel_time_s", _D), ("lag_time_p", _D), ("lag_time_s", _D),
    ("cc_p", _D), ("cc_s", _D),
)

# The 24 columns of a relocation, in file order.
RELOCATION = _schema(
    ("id", _L), ("lat", _D), ("lon", _D), ("depth_km", _D),
    ("x_m", _D), ("y_m", _D), ("z_m", _D), ("ex_m", _D), ("ey_m", _D), ("ez_m", _D),
    ("yr", _I), ("mo", _I), ("dy", _I), ("hr", _I), ("mi", _I), ("sc", _D), ("mag", _D),
    ("n_cc_p", _I), ("n_cc_s", _I), ("n_ct_p", _I), ("n_ct_s", _I),
    ("rms_cc", _D), ("rms_ct", _D), ("cluster_id", _I),
)

STATION_RESULT = _schema(
    ("sta", _S), ("lat", _D), ("lon", _D), ("dist_km", _D), ("az_deg", _D),
    ("n_cc_p", _I), ("n_cc_s", _I), ("n_ct_p", _I), ("n_ct_s", _I),
    ("rms_cc", _D), ("rms_ct", _D), ("cluster_id", _I),
)

# Sentinel of text files for "no data"; tables hold NULL.
NO_RMS = -9.0
