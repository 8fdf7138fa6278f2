"""Fixed values of the data model."""

from __future__ import annotations

# Clock of the devices and the code of a missing sample.
TICKS_PER_SECOND = 500
NO_SAMPLE = -(2**31)  # INT32_MIN: the waveform has no sample here

# Reading states carried in-band as negative values.
NO_DISPLAY, MOTION, VARIANCE, OVER, UNDER = -1, -2, -3, -4, -5
CUFF_INFLATING, WALKING, PPG_PERSISTENT, PPG_TRANSIENT, SENSOR_OFF = -6, -7, -8, -9, -10

# Seconds between readings of each parameter.
UPDATE_RATES = {
    "SPO2": 3.0, "PR": 3.0, "HR": 5.0, "RR": 5.0, "TEMP": 6.0,
    "CNIBP_MAP": 5.0, "CNIBP_DIA": 5.0, "CNIBP_SYS": 5.0, "TIME_SYNC": 60.0, "HR_A": 1.0,
}
UPDATE_RATES_COMBINED = {**UPDATE_RATES, "HR": 1.0}

# Edges (seconds) of the duration histograms.
DURATION_EDGES = (
    0, 30, 60, 90, 120, 150, 180, 210, 240, 270, 300, 360, 420, 480, 540, 600, 660, 720, 780,
    840, 900, 1200, 1500, 1800, 2100, 2400, 2700, 3000, 3300, 3600, 4200, 4800, 5400, 6000,
    6600, 7200,
)
LAST_BIN_LABEL = 7201

# Limits swept per parameter and side (first, last), step 1.
LIMIT_RANGES = {
    ("SPO2", "LOW"): (60, 100), ("PR", "HIGH"): (120, 180), ("PR", "LOW"): (25, 50),
    ("HR", "HIGH"): (120, 180), ("HR", "LOW"): (25, 50), ("HR_A", "HIGH"): (120, 180),
    ("HR_A", "LOW"): (25, 50), ("RR", "HIGH"): (15, 50),
    ("RR", "LOW"): (0, 15), ("BP_SYS", "HIGH"): (160, 210), ("BP_SYS", "LOW"): (65, 95),
    ("BP_MAP", "HIGH"): (100, 180), ("BP_MAP", "LOW"): (55, 65), ("BP_DIA", "HIGH"): (100, 155),
    ("BP_DIA", "LOW"): (35, 60), ("CNIBP_SYS", "HIGH"): (180, 210),
    ("CNIBP_SYS", "LOW"): (65, 95), ("CNIBP_MAP", "HIGH"): (145, 180),
    ("CNIBP_MAP", "LOW"): (55, 65), ("CNIBP_DIA", "HIGH"): (115, 155),
    ("CNIBP_DIA", "LOW"): (35, 45), ("TEMP", "HIGH"): (92, 109), ("TEMP", "LOW"): (32, 92),
}
# Delays of the sweep and leak of the alarm bucket, in seconds.
DELAY_MAX, DELAY_STEP = 600, 5
LEAK_PER_SECOND = 30

# Range of the value histograms.
VALUE_RANGES = {
    "SPO2": (49, 100), "PR": (0, 240), "HR": (0, 240), "RR": (0, 50),
    "CNIBP_SYS": (60, 240), "CNIBP_DIA": (40, 160), "CNIBP_MAP": (50, 185),
    "BP_SYS": (60, 240), "BP_DIA": (40, 160), "BP_MAP": (50, 185),
}

# Which monitored time divides the alarms of a parameter.
TIME_CLASS = {
    "PR": "time_wt", "SPO2": "time_wt", "CR": "time_wt",
    "HR": "time_cable", "RR": "time_cable", "TEMP": "time_cable", "HR_A": "time_cable",
    "BP_SYS": "time_total", "BP_DIA": "time_total", "BP_MAP": "time_total",
    "CARDIAC": "time_total",
    "CNIBP_SYS": "time_cnibp", "CNIBP_DIA": "time_cnibp", "CNIBP_MAP": "time_cnibp",
}

# State named by an annotation mark (symbol plus rhythm text).
MARK_TAGS = {
    "+(N": "NSR", "+(AFIB": "AFIB", "+(AFL": "AFL", "+(VFL": "VFIB", "+(VT": "VTACH",
    "[": "VFIB", "]": "NSR",
}

# Multipliers to engineering units.
SCALES = {
    "ECG": (1 / 6) * (4800 / 2**24),
    "PPG_DC": 3300 / 65535,
    "PPG_FILT": (1 / 9977) * (3300 / 65535),
    "IP": (1 / 4095) * (1 / 2) * 16 * (2400 / 2**24),
    "AMBIENT": 3300 / 4095,
    "ACC": 1 / 256,
    "PRES": 1 / 8,
    "TEMP": 1 / 100,
}
