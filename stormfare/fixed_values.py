"""Constants, labels and lookup tables that results depend on."""

# --- Fixed values: period and cleaning thresholds ---------------------------
YEAR = 2024
MONTHS = (1, 2, 3)
MIN_TRIP_DISTANCE = 0.1
MAX_TRIP_DISTANCE = 100.0
MIN_FARE_AMOUNT = 2.5
MAX_FARE_AMOUNT = 500.0
MIN_PASSENGER_COUNT = 1
MAX_PASSENGER_COUNT = 6
MIN_DURATION_MINUTES = 1.0
MAX_DURATION_MINUTES = 180.0

# --- Fixed values: unit conversions -----------------------------------------
KM_PER_MILE = 1.60934
KMH_PER_MS = 3.6

# --- Fixed values: payment codes --------------------------------------------
PAYMENT_LABELS = {
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}
CARD_PAYMENT = 1

# --- Fixed values: distance buckets (upper bound in km, label) ---------------
DISTANCE_BUCKETS = ((2, ">0-2km"), (5, "2-5km"))
LONG_DISTANCE_BUCKET = ">5km"
DISTANCE_BUCKET_LABELS = (">0-2km", "2-5km", ">5km")

# --- Fixed values: weather categories ---------------------------------------
WEATHER_FALLBACK = {
    "Orageux": ("Thunderstorm",),
    "Pluvieux": ("Rain", "Drizzle", "Snow"),
    "Clair": ("Clear", "Clouds"),
}
OTHER_WEATHER = "Autre"
UNKNOWN_WEATHER = "Inconnu"
FEED_WEATHER_CATEGORIES = ("Clair", "Nuageux", "Pluvieux", "Orageux")

# --- Fixed values: high-value zone criteria ----------------------------------
ZONE_MIN_TRIPS = 10
ZONE_MIN_SPENT = 300
ZONE_MIN_TIP_PCT = 15

# --- Fixed values: question parameters ---------------------------------------
PEAK_HOURS = (7, 8, 9, 17, 18, 19)
SHORT_TRIP_MINUTES = (1, 60)
HISTOGRAM_BINS = 60
SCATTER_MILES = (0, 30)
SAMPLE_ONE_IN = 4
SAMPLE_ROWS = 200_000

# --- Fixed values: row-count floors ------------------------------------------
MIN_FACT_ROWS = 1_000_000
MIN_WEATHER_ROWS = 100

# --- Fixed values: columns every raw trip file must carry --------------------
REQUIRED_TRIP_COLUMNS = (
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "trip_distance",
    "fare_amount",
    "tip_amount",
    "total_amount",
)
