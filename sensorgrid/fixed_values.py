"""They decide the results, so they are stated here as they are."""

from __future__ import annotations

# Air-quality index by PM2.5 concentration:
# (concentration from, concentration to, index from, index to).
AQI_BREAKPOINTS = (
    (0.0, 12.0, 0.0, 50.0),
    (12.1, 35.4, 51.0, 100.0),
    (35.5, 55.4, 101.0, 150.0),
    (55.5, 150.4, 151.0, 200.0),
    (150.5, 250.4, 201.0, 300.0),
    (250.5, 500.4, 301.0, 500.0),
)
AQI_MAX = 500

# Labels of an index value: upper bound (inclusive) of the first five classes,
# then the labels of all six.
AQI_CLASS_BOUNDS = (50, 100, 150, 200, 300)
AQI_CATEGORIES = (
    "Bon",
    "Modéré",
    "Mauvais pour sensibles",
    "Mauvais",
    "Très mauvais",
    "Dangereux",
)
AQI_COLORS = ("#00E400", "#FFFF00", "#FF7E00", "#FF0000", "#8F3F97", "#7E0023")
AQI_RECOMMENDATIONS = (
    "Qualité satisfaisante",
    "Acceptable",
    "Sensibles : limiter efforts",
    "Éviter efforts prolongés",
    "Rester à l'intérieur",
    "Urgence sanitaire",
)

# Air-quality percentage: 100 * (1 - (aqi / 300) ^ 0.7), clamped to 0..100.
PERCENT_ZERO_AT = 300
PERCENT_EXPONENT = 0.7

# Sport outdoors is advised up to this index.
SPORT_MAX_AQI = 100

# Hours of the day (inclusive ranges).
RUSH_HOURS = ((7, 9), (17, 19))
NIGHT_FROM, NIGHT_TO = 22, 5

# Part of the day by first hour; hours before the first entry are night as well.
DAY_PERIODS = ((6, "Matin"), (12, "Midi"), (14, "Après-midi"), (18, "Soir"), (22, "Nuit"))
NIGHT_PERIOD = "Nuit"

# Names by day of week, Monday = 0.
DAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
WEEKEND_DAYS = (5, 6)

# Defaults of the serving queries.
UNKNOWN_LABEL = "Inconnu"
UNKNOWN_COLOR = "#888888"
HISTORY_SIZE = 500
OVERVIEW_SIZE = 100
PAGE_SIZE = 100
DEFAULT_HOURS = 24

# Event-time window and lateness of the zone averages.
ZONE_WINDOW = "1 minute"
ZONE_WATERMARK = "30 seconds"

# Station network: zone -> name, factors, stations (id, lat, lon, variation).
STATION_NETWORK = {
    "centre_ville": {
        "zone_name": "Centre-Ville",
        "pm_factor": 1.2,
        "variability": 0.15,
        "rush_hour_boost": 1.3,
        "night_reduction": 0.85,
        "stations": [
            ("CV_001", 47.5103, 6.7983, 1.0),
            ("CV_002", 47.5110, 6.7970, 1.05),
            ("CV_003", 47.5095, 6.7995, 0.95),
        ],
    },
    "zone_industrielle": {
        "zone_name": "Zone Industrielle",
        "pm_factor": 1.4,
        "variability": 0.25,
        "rush_hour_boost": 1.1,
        "night_reduction": 0.7,
        "stations": [
            ("ZI_001", 47.4950, 6.8150, 1.0),
            ("ZI_002", 47.4940, 6.8170, 1.15),
            ("ZI_003", 47.4960, 6.8130, 0.90),
            ("ZI_004", 47.4945, 6.8160, 1.10),
        ],
    },
    "residentiel": {
        "zone_name": "Quartier Résidentiel",
        "pm_factor": 0.9,
        "variability": 0.10,
        "rush_hour_boost": 1.15,
        "night_reduction": 0.95,
        "stations": [
            ("RES_001", 47.5150, 6.7850, 1.0),
            ("RES_002", 47.5160, 6.7840, 0.95),
        ],
    },
    "parc_pres_la_rose": {
        "zone_name": "Parc Près-la-Rose",
        "pm_factor": 0.6,
        "variability": 0.08,
        "rush_hour_boost": 1.05,
        "night_reduction": 1.0,
        "stations": [
            ("PARC_001", 47.5050, 6.7880, 1.0),
            ("PARC_002", 47.5055, 6.7890, 0.98),
            ("PARC_003", 47.5045, 6.7875, 1.02),
        ],
    },
    "peripherie": {
        "zone_name": "Périphérie",
        "pm_factor": 0.75,
        "variability": 0.12,
        "rush_hour_boost": 1.2,
        "night_reduction": 0.9,
        "stations": [
            ("PER_001", 47.5200, 6.8100, 1.0),
            ("PER_002", 47.5210, 6.8090, 1.05),
        ],
    },
}

# Raw record: the device's own field names.
RAW_TEXT_FIELDS = ("date", "time")
RAW_COUNT_FIELDS = (
    "pm10_cf1",
    "pm25_cf1",
    "pm100_cf1",
    "pm10_std",
    "pm25_std",
    "pm100_std",
    "gr03um",
    "gr05um",
    "gr10um",
    "gr25um",
    "gr50um",
    "gr100um",
)

# Columns of the reading table and their text lengths (None: no text column).
READING_TEXT_LENGTHS = {
    "sensor_id": 50,
    "zone_id": 50,
    "zone_name": 100,
    "date": 10,
    "time": 8,
    "aqi_category": 50,
    "aqi_color": 10,
    "aqi_recommendation": 100,
    "day_name": 15,
    "period": 20,
}
READING_REQUIRED = ("sensor_id", "zone_id", "zone_name", "datetime")
ZONE_TEXT_LENGTHS = {
    "zone_id": 50,
    "zone_name": 100,
    "zone_aqi_category": 50,
    "zone_aqi_color": 10,
    "zone_recommendation": 100,
}
ZONE_REQUIRED = ("window_start", "window_end", "zone_id", "zone_name")
