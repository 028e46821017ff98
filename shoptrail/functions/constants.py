"""Codes, weights, labels and limits that results must carry exactly."""

# behaviour codes
BROWSE, FAVOURITE, CART, BUY = 1, 2, 3, 4
BEHAVIOURS = (BROWSE, FAVOURITE, CART, BUY)

# weights per behaviour code
IMPLICIT_WEIGHTS = {1: 1.0, 2: 2.0, 3: 3.0, 4: 4.0}
VALUE_WEIGHTS = {1: 1, 2: 2, 3: 3, 4: 5}

# the event table
EVENT_COLUMNS = ("user_id", "item_id", "behavior_type", "time", "item_category")
EVENT_KEY = ("user_id", "item_id", "behavior_type", "time")

# parts of the day
NIGHT, MORNING, AFTERNOON, EVENING = "凌晨", "上午", "下午", "晚上"

# short-term activity levels: lower bounds 100 and 30
LEVEL_HIGH, LEVEL_MID, LEVEL_LOW = "短期高活跃用户", "短期中活跃用户", "短期低活跃用户"

# activity groups: below 10, 10 to 50, above 50
GROUP_LOW, GROUP_MID, GROUP_HIGH = "低活跃用户", "中活跃用户", "高活跃用户"

# value segments of buyers
SEGMENT_HIGH, SEGMENT_POTENTIAL, SEGMENT_RISK, SEGMENT_DORMANT = (
    "High Value", "Potential", "At Risk", "Dormant",
)

# signs of a coefficient
PROMOTES, INHIBITS = "促进购买", "抑制购买"

# prediction errors
CORRECT, FALSE_POSITIVE, FALSE_NEGATIVE = "正确预测", "假阳性_FP", "假阴性_FN"

# scenarios of the error analysis
SCENARIO_ALL = "整体样本"
SCENARIO_COLD, SCENARIO_WARM = "冷启动用户", "非冷启动用户"
SCENARIO_TAIL, SCENARIO_HEAD = "长尾商品", "非长尾商品"

# score segments and priorities of the experiment
SCORE_SEGMENTS = ("低潜", "较低潜", "中潜", "较高潜", "高潜")
SEGMENT_EVERYONE = "全部"
PRIORITY_LOW, PRIORITY_MID, PRIORITY_HIGH = "低", "中", "高"

# experiment design
ALPHA = 0.05
Z_ALPHA = 1.959963984540054
Z_BETA = 0.8416212335729143
TARGET_TOP_RATIO = 0.20
TEST_RATIO = 0.50
EXPECTED_RELATIVE_LIFT = 0.15
DAILY_REACH_RATE = 0.10
MIN_EXPERIMENT_DAYS, MAX_EXPERIMENT_DAYS = 14, 28
DEFAULT_ORDER_VALUE = 100.0
INCENTIVE_COST_PER_USER = 2.0
VARIABLE_COST_RATE = 0.30

# stacking
BASE_PROBABILITIES = ("logistic_prob", "xgboost_prob", "din_prob")
MODEL_LABELS = {
    "logistic_prob": "Logistic Regression",
    "xgboost_prob": "XGBoost",
    "din_prob": "DIN",
    "stacking_prob": "Stacking",
}

SEED = 42
