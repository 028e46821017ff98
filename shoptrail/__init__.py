"""User-behaviour analytics and purchase prediction on Spark."""

from .plans.stages import (
    run_behavior_sequence_features,
    run_build_feature_table,
    run_build_model_dataset,
    run_business_ab_test,
    run_business_features,
    run_clean_data,
    run_data_pipeline,
    run_deep_learning_models,
    run_exploratory_analysis,
    run_feature_pipeline,
    run_feature_preprocessing,
    run_full_pipeline,
    run_implicit_features,
    run_item_lifecycle_features,
    run_lightgbm,
    run_load_data,
    run_logistic_regression,
    run_model_comparison,
    run_model_fusion,
    run_parallel_read,
    run_sqlite_analysis,
    run_time_features,
    run_traditional_models,
    run_user_lifecycle_features,
    run_xgboost,
    save_tables,
)

__version__ = "0.1.0"
__all__ = [name for name in dir() if name.startswith("run_")] + ["save_tables"]
