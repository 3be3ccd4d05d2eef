from gamelake.functions.semantics import (  # noqa: F401
    cents_to_dollars, datediff_boundary, safe_ratio, to_array, to_string_array,
)
from gamelake.functions.classify import (  # noqa: F401
    balance_rating, bucket, churn_segment, item_category, ltv_bucket, mmr_segment,
)
