"""Column contracts. Everything in this file is a fixed value of the data."""

from pyspark.sql import types as T

EXPOSURE_RENAMES = {
    "SourceData": "source_data",
    "PolicyNo": "policy_no",
    "PolicyNumber": "policy_number",
    "PolicyInceptionDate": "policy_inception_date",
    "ItemInceptionDate": "item_inception_date",
    "CancelledDate": "cancelled_date",
    "EFF_FROM_DATE": "eff_from_date",
    "EFF_TO_DATE": "eff_to_date",
    "SectionCode": "section_code",
    "CoverCode": "cover_code",
    "ItemDescription": "item_description",
    "VehMake": "veh_make",
    "VehModel": "veh_model",
    "Registration": "registration",
    "VinNumber": "vin_number",
    "IMEINumber": "imei_number",
    "CoverPremium": "cover_premium",
    "CoverSumInsured": "cover_sum_insured",
    "CoverDescription": "cover_description",
    "PolicyStatus": "policy_status",
    "CoverStatus": "cover_status",
    "LOB_ASSET_ID": "lob_asset_id",
    "ItemNo": "item_no_raw",
    "PolicyCancellationReasonCode": "policy_cancellation_reason_code",
    "enddate": "end_date",
    "effectivefromdate": "effective_from_date",
    "effectivetodate": "effective_to_date",
    "EffectiveYearMonth": "effective_year_month",
    "EffectiveYear": "effective_year",
    "EffectiveQuarter": "effective_quarter",
    "EffectiveMonth": "effective_month",
    "EffectiveYearQuarter": "effective_year_quarter",
    "ItemCancelledDate": "item_cancelled_date",
    "PremiumPaid": "premium_collected",
    "ACTIVE_LOB_ASSET_ID": "active_lob_asset_id",
}

MAPPING_COLUMNS = (
    "source_data",
    "policy_version_number",
    "policy_product_description",
    "policy_number",
    "item_no",
    "premium",
    "premium_collected",
    "cover_sum_insured",
    "active_lob_asset_id",
    "original_lob_asset_id",
    "vin_number",
    "imei_number",
    "make",
    "model",
    "registration_number",
    "section_code",
    "cover_code",
    "item_description",
    "cover_description",
    "policy_status",
    "cover_status",
    "policy_cancellation_reason_code",
    "item_inception_datetime",
    "policy_inception_date",
    "item_cancellation_date",
    "policy_cancellation_date",
    "imei_first_detection_datetime",
    "installation_datetime",
    "effective_year_month",
    "effective_from_date",
    "effective_to_date",
    "inserted_timestamp",
)

# Trip measures: the first four lie in [0, 1].
TRIP_MEASURES = (
    "hard_accel",
    "hard_brake",
    "legal",
    "overall_score",
    "distance",
    "trip_duration",
    "late_drive_duration",
)
LATE_DRIVE = "late_drive"
DRIVER_KEYS = ("sentiance_id", "policy_number", "item_no", "imei_number")
POLICY_KEYS = ("policy_number", "item_no", "imei_number")

# Score components and whether more of them is good or bad driving.
SCORE_COMPONENTS = {
    "avg_hard_accel": "bad",
    "avg_hard_brake": "bad",
    "avg_legal": "good",
    "avg_overall_score": "good",
    "late_drive_ratio": "bad",
}

CLIENT_ORDER = (
    "policy_number", "item_no", "imei_number", "sentiance_id",
    "avg_hard_accel", "avg_hard_brake", "avg_legal", "avg_overall_score",
    "any_late_drive", "total_distance", "total_trip_duration",
    "total_late_drive_duration", "trip_count", "late_drive_ratio",
    "driving_score", "earning_borderline_driving_score",
    "bandwidth", "nearest_ms_cluster", "nearest_ms_center", "ms_center_gap",
    "min_ms_center", "max_ms_center", "no_drivers_per_group",
    "premium_collected", "cashback_percent", "cashback_amount",
    "scaling_factor", "scaled_cashback_amount",
)

REWARDS_SCHEMA = T.StructType(
    [
        T.StructField("policy_number", T.StringType(), False),
        T.StructField("original_lob_asset_id", T.StringType()),
        T.StructField("item_no", T.StringType(), False),
        T.StructField("item_description", T.StringType()),
        T.StructField("imei_number", T.StringType()),
        T.StructField("sentiance_id", T.StringType()),
        T.StructField("avg_hard_accel", T.DoubleType()),
        T.StructField("avg_hard_brake", T.DoubleType()),
        T.StructField("avg_legal", T.DoubleType()),
        T.StructField("avg_overall_score", T.DoubleType()),
        T.StructField("any_late_drive", T.StringType()),
        T.StructField("total_distance", T.DoubleType()),
        T.StructField("total_trip_duration", T.DoubleType()),
        T.StructField("total_late_drive_duration", T.DoubleType()),
        T.StructField("trip_count", T.IntegerType()),
        T.StructField("late_drive_ratio", T.DoubleType()),
        T.StructField("driving_score", T.DoubleType()),
        T.StructField("earning_borderline_driving_score", T.DoubleType()),
        T.StructField("bandwidth", T.DoubleType()),
        T.StructField("nearest_ms_cluster", T.IntegerType()),
        T.StructField("nearest_ms_center", T.DoubleType()),
        T.StructField("ms_center_gap", T.DoubleType()),
        T.StructField("min_ms_center", T.DoubleType()),
        T.StructField("max_ms_center", T.DoubleType()),
        T.StructField("no_drivers_per_group", T.IntegerType()),
        T.StructField("premium_charged", T.DoubleType()),
        T.StructField("premium_collected", T.DoubleType()),
        T.StructField("cashback_percent", T.DoubleType()),
        T.StructField("cashback_amount", T.DoubleType()),
        T.StructField("scaling_factor", T.DoubleType()),
        T.StructField("scaled_cashback_amount", T.DoubleType()),
        T.StructField("no_trip_flag", T.IntegerType()),
        T.StructField("reward_category", T.StringType()),
        T.StructField("cycle_reward_thresh", T.DoubleType()),
        T.StructField("cycle_start_date", T.DateType()),
        T.StructField("cycle_end_date", T.DateType()),
        T.StructField("cycle_maturation_date", T.DateType()),
        T.StructField("calculated_datetime", T.TimestampType()),
        T.StructField("cycle_number", T.IntegerType(), False),
    ]
)
REWARD_KEYS = ("policy_number", "item_no", "cycle_number")

GEOCODE_COLUMNS = (
    "id",
    "inputAddress",
    "score",
    "scoreRank",
    "freeformAddress",
    "countryCode",
    "municipality",
    "streetName",
    "postalCode",
    "lat",
    "lon",
    "matchType",
    "error",
)

GEOCODE_RESPONSE = T.StructType().add(
    "results",
    T.ArrayType(
        T.StructType()
        .add("type", T.StringType())
        .add("score", T.DoubleType())
        .add(
            "address",
            T.StructType()
            .add("freeformAddress", T.StringType())
            .add("countryCode", T.StringType())
            .add("municipality", T.StringType())
            .add("streetName", T.StringType())
            .add("postalCode", T.StringType()),
        )
        .add("position", T.StructType().add("lat", T.DoubleType()).add("lon", T.DoubleType()))
    ),
)

# Flood statistics: peril code -> column prefix, return periods in years.
PERILS = {"FLRF_U": "river_flood", "FLSW_U": "surface_water_flood"}
RETURN_PERIODS = (20, 50, 100, 200, 500, 1500)
PROTECTED_PERIL = "FLRF_U"

FLOOD_SCORE_NAMES = {
    "River_Floodscore_Def": "river_flood_score_defended",
    "River_Floodscore_UD": "river_flood_score_undefended",
    "Surfacewater_Floodscore_UD": "surface_water_flood_score_undefended",
    "FloodScore_Def": "overall_flood_score_defended",
    "FloodScore_UD": "overall_flood_score_undefended",
    "Floodability_Def": "floodability_defended",
    "Floodability_UD": "floodability_undefended",
}


def statistic_names(period: int) -> dict[str, str]:
    """Statistic as delivered for a return period -> end of its column name."""
    return {
        f"ppa{period}": "affected_area_percentage",
        f"min{period}": "min_depth_meters",
        f"max{period}": "max_depth_meters",
        "mean": "mean_depth_meters",
        "std_dev": "std_dev_depth_meters",
    }


def flood_depth_paths() -> dict[str, str]:
    """Path inside a depth item -> flat column name, 61 of them."""
    paths = {}
    for peril, prefix in PERILS.items():
        for period in RETURN_PERIODS:
            for statistic, ending in statistic_names(period).items():
                path = f"stats.{peril}.rp_{period}.{statistic}"
                paths[path] = f"{prefix}_rp{period}_{ending}"
        if peril == PROTECTED_PERIL:
            paths[f"stats.{peril}.sop"] = f"{prefix}_standard_of_protection_rp"
    return paths


def flood_depth_schema() -> T.ArrayType:
    stats = T.StructType()
    for peril in PERILS:
        periods = T.StructType()
        for period in RETURN_PERIODS:
            values = T.StructType()
            for statistic in statistic_names(period):
                values.add(statistic, T.DoubleType())
            periods.add(f"rp_{period}", values)
        if peril == PROTECTED_PERIL:
            periods.add("sop", T.DoubleType())
        stats.add(peril, periods)
    return T.ArrayType(T.StructType().add("id", T.StringType()).add("stats", stats))


def flood_score_schema() -> T.ArrayType:
    item = T.StructType().add("id", T.StringType())
    for name in FLOOD_SCORE_NAMES:
        item.add(name, T.DoubleType())
    return T.ArrayType(item)
