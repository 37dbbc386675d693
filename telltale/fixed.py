"""Fixed values of the connected-car example; they must stay exactly as they are."""

# Columns of the wide car view as (column, family, qualifier).
CAR_WIDE_COLUMNS = (
    ("blood_pressure", "driver", "driver-blood-pressure"),
    ("tire_pressure", "car", "tire-pressure"),
    ("ultrasonic_sensor_front", "car", "ultrasonic-sensor-front"),
    ("ultrasonic_sensor_back", "car", "ultrasonic-sensor-back"),
    ("current_speed", "car", "current-speed"),
    ("current_location_long", "car", "current-location-long"),
    ("current_location_lat", "car", "current-location-lat"),
    ("value", "car", "value"),
)

# Formats of times on the wire, in row keys and in window labels.
SECONDS_FORMAT = "yyyyMMddHHmmss"
MINUTES_FORMAT = "yyyyMMddHHmm"
LABEL_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Width of a window in seconds and number of windows of a batch run.
WINDOW_SECONDS = 300
WINDOW_COUNT = 1000
