"""Names, texts, formats and thresholds that results must carry unchanged."""

# --- raw streams -----------------------------------------------------------------------
STREAM_FILE = "data_stream-oper_stepType-{stream}.parquet"
STREAMS = ("instant", "accum", "avg", "max")
JOIN_KEYS = ("time", "latitude", "longitude")
FINAL_VERSION = 1
PRELIMINARY_VERSION = 5
LAG_DAYS = 5
AREA = {"north": 44.5, "west": 68.0, "south": 38.0, "east": 82.0}
HOURS = tuple(range(24))

# --- units and rounding ----------------------------------------------------------------
ZERO_CELSIUS_IN_KELVIN = 273.15
PA_PER_HPA = 100
MM_PER_M = 1000

# --- load ------------------------------------------------------------------------------
INSERT_BATCH = 50_000

# --- key indicators --------------------------------------------------------------------
FALLBACK_YEAR = 2024
HOT_LIMIT = 35
COLD_LIMIT = -20
TREND_YEARS = 10
KPI_WARMER = "🔥 Теплее нормы"
KPI_COLDER = "❄️ Холоднее нормы"
KPI_NORMAL = "✅ В пределах нормы"
KPI_MORE_DAYS = ("🔺 На ", " дней больше нормы")
KPI_NOT_MORE_DAYS = "📉 Ниже или равно норме"
KPI_WORSE = "delta-negative"
KPI_BETTER = "delta-positive"
KPI_NEUTRAL = "delta-neutral"
KPI_NO_DATA = "no data"

# --- correlation factors: code, shown name, column -------------------------------------
FACTORS = (
    ("radiation", "Солнечная радиация", "solar_radiation"),
    ("dewpoint", "Точка росы (Влажность)", "dewpoint_c"),
    ("pressure", "Атм. Давление", "pressure_hpa"),
    ("clouds", "Облачность", "cloud_cover"),
    ("wind", "Скорость ветра", "wind_speed_ms"),
    ("precip", "Осадки", "precipitation_mm"),
)
POSITIVE_COLOUR = "#FF6B6B"
OTHER_COLOUR = "#4ECDC4"

# --- drill-down ------------------------------------------------------------------------
DRILL_START_YEAR = 2000
DRILL_END_YEAR = 2025

# --- regression model ------------------------------------------------------------------
TARGET = "temperature_c"
FEATURES = (
    "pressure_hpa",
    "dewpoint_c",
    "precipitation_mm",
    "wind_speed_ms",
    "cloud_cover",
    "solar_radiation",
    "latitude",
    "longitude",
    "month",
    "hour",
    "day_of_week",
)
TREES = 100
TREE_DEPTH = 15
SEED = 42
TEST_SHARE = 0.2
SAMPLE_BUCKETS = 20
R2_EXCELLENT = 0.9
R2_GOOD = 0.7
GRADE_EXCELLENT = "🌟 Отличный результат!"
GRADE_GOOD = "👍 Хороший результат."
GRADE_MORE_DATA = "⚠️ Результат так себе, нужно больше данных."
SLICE_ROWS = 150

# --- forecast --------------------------------------------------------------------------
WINDOW_ROWS = 168
BAND_BASE = 1.5
BAND_PER_HOUR = 0.05
FORECAST_TEXT = "Прогноз: %d...%d°C"

# --- recommendations: sector, icon, status, action, detail -----------------------------
UTILITIES = "ЖКХ и Энергетика"
UTILITIES_FROST = (UTILITIES, "🔥", "danger", "Внимание! Сильные морозы.", "Повысить температуру теплоносителя.")
UTILITIES_WINTER = (UTILITIES, "🏢", "warning", "Штатный зимний режим.", "Мониторинг давления газа.")
UTILITIES_MILD = (UTILITIES, "💡", "success", "Экономичный режим.", "Снизить нагрузку на сети.")
FARMING = "Сельское хозяйство"
FARMING_DROUGHT = (FARMING, "🌾", "danger", "Угроза засухи!", "Активировать полив.")
FARMING_GOOD = (FARMING, "🚜", "success", "Благоприятные условия.", "Посевные работы в норме.")
FARMING_FROST = (FARMING, "❄️", "warning", "Риск заморозков.", "Укрыть культуры.")
TRANSPORT = "Транспорт и МЧС"
TRANSPORT_STORM = (TRANSPORT, "⚠️", "danger", "Штормовое предупреждение.", "Ограничить движение.")
TRANSPORT_ICE = (TRANSPORT, "🚗", "warning", "Гололедица.", "Подготовить реагенты.")
TRANSPORT_CLEAR = (TRANSPORT, "✅", "success", "Дороги чистые.", "Штатный режим.")
SEVERE_FROST_C = -15
FREEZING_C = 0
HEAT_C = 30
DROUGHT_MM = 1
GROWING_MIN_C = 5
GROWING_MAX_C = 25
STORM_WIND_MS = 10
STORM_RAIN_MM = 20
ICE_RAIN_MM = 5
