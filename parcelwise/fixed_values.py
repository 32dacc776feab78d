"""Values fixed by the data and the published behaviour; stated as they are, not computed."""

# --- fixed values: names ---------------------------------------------------
TARGET = "SalePrice"
ID_COLUMNS = ["PID", "Order"]

# Applied after "_" has become " " in every name.
NAME_OVERRIDES = {
    "Sale Price": "SalePrice",
    "Year Sold": "Yr Sold",
    "First Flr SF": "1st Flr SF",
    "Second Flr SF": "2nd Flr SF",
    "Three season porch": "3Ssn Porch",
    "Year Remod Add": "Year Remod/Add",
}
EXTRA_COLUMNS = ["Longitude", "Latitude"]

ORDINAL_COLUMNS = ["Overall Qual", "Overall Cond"]
ORDINAL_LABELS = {
    "Very Poor": 1,
    "Poor": 2,
    "Fair": 3,
    "Below Average": 4,
    "Average": 5,
    "Above Average": 6,
    "Good": 7,
    "Very Good": 8,
    "Excellent": 9,
    "Very Excellent": 10,
}

# Text tokens read as missing.
NULL_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
               "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]

# Columns looked at by the listed variant of the high-missing drop.
LISTED_MISSING_COLUMNS = [
    "Lot Frontage", "Alley", "Mas Vnr Type", "Mas Vnr Area", "Bsmt Qual", "Bsmt Cond",
    "Bsmt Exposure", "BsmtFin Type 1", "BsmtFin SF 1", "BsmtFin Type 2", "BsmtFin SF 2",
    "Bsmt Unf SF", "Total Bsmt SF", "Electrical", "Bsmt Full Bath", "Bsmt Half Bath",
    "Fireplace Qu", "Garage Type", "Garage Yr Blt", "Garage Finish", "Garage Cars",
    "Garage Area", "Garage Qual", "Garage Cond", "Pool QC", "Fence", "Misc Feature",
]

# --- fixed values: thresholds and defaults ---------------------------------
MISSING_THRESHOLD = 0.30
SKEW_THRESHOLD = 0.75
RARE_THRESHOLD = 0.01
RARE_LABEL = "Other"
IQR_FACTOR = 1.5
TEST_SIZE = 0.15
VAL_SIZE = 0.15
SEED = 42
CV_FOLDS = 5
SEARCH_TRIALS = 50
BAND_WIDTH = 0.09
MODEL_VERSION = "0.1.0"
PRICE_BANDS = [0.0, 50000.0, 100000.0, 150000.0, 200000.0, 250000.0, 300000.0, 400000.0]

BOOSTING_GRID = {
    "learning_rate": [0.05, 0.1, 0.2],
    "n_estimators": [50, 100, 200],
    "max_depth": [3, 5, 7],
    "min_samples_leaf": [1, 2, 4],
}

# --- fixed values: scoring request -----------------------------------------
QUALITY_LABELS = ["Ex", "Gd", "TA", "Fa", "Po", "NA"]

# field, canonical column, type, default, lower bound, upper bound.
# A default of REQUIRED means the field must be given; "=X" copies field X.
# "> n" is exclusive, ">= n" and "<= n" inclusive.
REQUIRED = object()
REQUEST_FIELDS = [
    ("OverallQual", "Overall Qual", "int", REQUIRED, ">= 1", "<= 10"),
    ("GrLivArea", "Gr Liv Area", "double", REQUIRED, "> 0", None),
    ("YearBuilt", "Year Built", "int", REQUIRED, ">= 1800", "<= 2025"),
    ("OverallCond", "Overall Cond", "int", 5, ">= 1", "<= 10"),
    ("TotalBsmtSF", "Total Bsmt SF", "double", 0.0, ">= 0", None),
    ("1stFlrSF", "1st Flr SF", "double", "=GrLivArea", ">= 0", None),
    ("2ndFlrSF", "2nd Flr SF", "double", 0.0, ">= 0", None),
    ("GarageCars", "Garage Cars", "double", 1.0, ">= 0", "<= 5"),
    ("GarageArea", "Garage Area", "double", 0.0, ">= 0", None),
    ("FullBath", "Full Bath", "int", 1, ">= 0", "<= 6"),
    ("HalfBath", "Half Bath", "int", 0, ">= 0", "<= 3"),
    ("BsmtFullBath", "Bsmt Full Bath", "double", 0.0, ">= 0", None),
    ("BsmtHalfBath", "Bsmt Half Bath", "double", 0.0, ">= 0", None),
    ("TotRmsAbvGrd", "TotRms AbvGrd", "int", 6, ">= 1", "<= 20"),
    ("Fireplaces", "Fireplaces", "int", 0, ">= 0", "<= 4"),
    ("LotArea", "Lot Area", "double", 9600.0, "> 0", None),
    ("LotFrontage", "Lot Frontage", "double", 69.0, ">= 0", None),
    ("YearRemodAdd", "Year Remod/Add", "int", "=YearBuilt", ">= 1800", "<= 2025"),
    ("YrSold", "Yr Sold", "int", 2010, ">= 2006", "<= 2025"),
    ("MoSold", "Mo Sold", "int", 6, ">= 1", "<= 12"),
    ("PoolArea", "Pool Area", "double", 0.0, ">= 0", None),
    ("WoodDeckSF", "Wood Deck SF", "double", 0.0, ">= 0", None),
    ("OpenPorchSF", "Open Porch SF", "double", 0.0, ">= 0", None),
    ("EnclosedPorch", "Enclosed Porch", "double", 0.0, ">= 0", None),
    ("ScreenPorch", "Screen Porch", "double", 0.0, ">= 0", None),
    ("MasVnrArea", "Mas Vnr Area", "double", 0.0, ">= 0", None),
    ("MSZoning", "MS Zoning", "string", "RL", None, None),
    ("Neighborhood", "Neighborhood", "string", "NAmes", None, None),
    ("BldgType", "Bldg Type", "string", "1Fam", None, None),
    ("HouseStyle", "House Style", "string", "1Story", None, None),
    ("ExterQual", "Exter Qual", "string", "TA", None, None),
    ("ExterCond", "Exter Cond", "string", "TA", None, None),
    ("Foundation", "Foundation", "string", "PConc", None, None),
    ("BsmtQual", "Bsmt Qual", "string", "TA", None, None),
    ("BsmtExposure", "Bsmt Exposure", "string", "No", None, None),
    ("HeatingQC", "Heating QC", "string", "Ex", None, None),
    ("CentralAir", "Central Air", "string", "Y", None, None),
    ("KitchenQual", "Kitchen Qual", "string", "TA", None, None),
    ("GarageType", "Garage Type", "string", "Attchd", None, None),
    ("GarageFinish", "Garage Finish", "string", "Unf", None, None),
    ("PavedDrive", "Paved Drive", "string", "Y", None, None),
    ("SaleType", "Sale Type", "string", "WD", None, None),
    ("SaleCondition", "Sale Condition", "string", "Normal", None, None),
]
QUALITY_FIELDS = ["ExterQual", "ExterCond", "BsmtQual", "HeatingQC", "KitchenQual"]
