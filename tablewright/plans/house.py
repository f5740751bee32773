"""Fixed values for the house-price table: column lists, roles and text-table features."""

from __future__ import annotations

from ..operators.catalog import Catalog
from ..operators.encode import HOUSE_ORDINALS, QUALITY_LEVELS
from ..operators.missing import ImputePlan

KEY = "Id"
TARGET = "SalePrice"

#: A gap means that the house has no such thing.
ABSENT_MEANING = {
    "PoolQC": "No Pool",
    "Alley": "No alley access",
    "Fence": "No Fence",
    "FireplaceQu": "No Fireplace",
    "GarageType": "No Garage",
    "GarageFinish": "No Garage",
    "GarageQual": "No Garage",
    "GarageCond": "No Garage",
    "BsmtQual": "No Basement",
    "BsmtCond": "No Basement",
    "BsmtExposure": "No Basement",
    "BsmtFinType1": "No Basement",
    "BsmtFinType2": "No Basement",
    "MiscFeature": "No Misc Feature",
}

IMPUTE = ImputePlan(
    absent=list(ABSENT_MEANING),
    zero=[
        "GarageArea", "GarageCars", "BsmtFinSF1", "BsmtFinSF2", "BsmtUnfSF", "TotalBsmtSF", "BsmtFullBath", "BsmtHalfBath",
    ],
    median=["LotFrontage"],
    mode={"Electrical": "SBrkr"},
)

CATALOG = Catalog(
    roles={
        "numeric continuous": ["LotArea", "GrLivArea", "TotalBsmtSF", "GarageArea", "MasVnrArea", "LotFrontage"],
        "numeric count": ["FullBath", "HalfBath", "BedroomAbvGr", "TotRmsAbvGrd", "GarageCars", "Fireplaces"],
        "ordinal": [
            "ExterQual", "ExterCond", "KitchenQual", "HeatingQC", "BsmtQual", "BsmtCond", "GarageQual", "GarageCond", "FireplaceQu",
        ],
        "nominal": [
            "Neighborhood", "MSZoning", "BldgType", "HouseStyle", "RoofStyle", "Exterior1st", "Exterior2nd", "SaleType", "SaleCondition",
        ],
        "binary": ["CentralAir", "Street"],
        "special": ["MSSubClass", "MoSold", "YrSold"],
        "target": [TARGET],
        "id": [KEY],
    },
    treatments={
        "numeric continuous": "standard scale",
        "numeric count": "standard scale",
        "ordinal": "ordinal codes",
        "nominal": "one column per level",
        "binary": "map to 0 and 1",
        "special": "text, then one column per level",
        "target": "log1p",
        "id": "dropped",
    },
    ordinal_levels={
        c: QUALITY_LEVELS
        for c in [
            "ExterQual", "ExterCond", "KitchenQual", "HeatingQC", "BsmtQual", "BsmtCond", "GarageQual", "GarageCond", "FireplaceQu",
        ]
    },
    binary_maps={"CentralAir": {"Y": 1, "N": 0}, "Street": {"Pave": 1, "Grvl": 0}},
)

#: Features of a table by theme, checked like roles.
GROUPS = Catalog(
    roles={
        "size_area": ["LotArea", "GrLivArea", "TotalBsmtSF", "1stFlrSF", "2ndFlrSF"],
        "quality_condition": ["OverallQual", "OverallCond", "KitchenQual", "ExterQual", "HeatingQC"],
        "house_age": ["YearBuilt", "YearRemodAdd", "GarageYrBlt"],
        "location": ["Neighborhood", "Condition1", "Street"],
        "utilities": [
            "GarageCars", "GarageArea", "FullBath", "HalfBath", "BedroomAbvGr", "TotRmsAbvGrd", "Fireplaces", "PoolArea",
        ],
        "transaction": ["SaleType", "SaleCondition", "YrSold", "MoSold"],
    }
)

ENGINEERED_NUMERIC = ["TotalSF", "HouseAge", "RemodAge", "TotalBath"]
ENGINEERED_FLAGS = ["HasGarage", "HasBasement", "HasFireplace"]
SENSITIVITY_FEATURES = ["OverallQual", "GrLivArea", "GarageCars"]
RELATED_FEATURES = ["OverallQual", "GrLivArea", "GarageArea", "TotalBsmtSF"]
GAIN_CANDIDATES = ["1stFlrSF", "2ndFlrSF", "TotalBsmtSF", "GrLivArea", "TotalSF"]
SEGMENTS = ["Neighborhood", "OverallQual", "HouseStyle", "SaleCondition"]

#: Category columns of the boosted model; LotShape and LandSlope count as ordinal only.
BOOST_NOMINAL = [
    "MSZoning", "Neighborhood", "Street", "LandContour", "LotConfig", "Utilities", "Condition1", "Condition2", "BldgType",
    "HouseStyle", "RoofStyle", "RoofMatl", "Exterior1st", "Exterior2nd", "MasVnrType", "Foundation", "Heating", "Electrical",
    "GarageType", "SaleType", "SaleCondition", "PavedDrive",
]
BOOST_SPECIAL = ["MSSubClass", "MoSold"]
BOOST_ORDINALS = HOUSE_ORDINALS
BOOST_BINARY = {"CentralAir": {"N": 0, "Y": 1}}
