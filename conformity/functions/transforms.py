"""Named column transforms that configurations refer to."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRANSFORMS: dict[str, Callable[..., Column]] = {}


def transform(*names: str) -> Callable[[Callable[..., Column]], Callable[..., Column]]:
    """Register a transform (df, **args) -> Column under one or more names."""

    def register(fn: Callable[..., Column]) -> Callable[..., Column]:
        for name in names:
            if name in TRANSFORMS:
                raise ValueError(f"Transform registered twice: {name}")
            TRANSFORMS[name] = fn
        return fn

    return register


def _number(column: str) -> Column:
    return F.col(column).try_cast("double")


@transform("net_given", "shopify_line_revenue")
def net_given(df: DataFrame, net: str = "discountedTotal") -> Column:
    """The net amount of a line as the source gives it."""
    return F.round(_number(net), 4)


@transform("discount_pct_from_net", "shopify_line_discount_pct")
def discount_pct_from_net(df: DataFrame, net: str = "discountedTotal", unit: str = "unitPrice", quantity: str = "quantity") -> Column:
    """Discount in percent from net and gross; 0 where gross is 0 or anything is missing."""
    share = F.try_divide(_number(net), _number(unit) * _number(quantity))
    return F.round(F.coalesce((F.lit(1.0) - share) * 100, F.lit(0.0)), 4)


@transform("net_from_discount_pct", "cin7_line_revenue")
def net_from_discount_pct(df: DataFrame, unit: str = "unitPrice", quantity: str = "qty", discount: str = "discount") -> Column:
    """Net amount from unit price, quantity and a discount in percent (missing: none)."""
    return F.round(_number(unit) * _number(quantity) * (F.lit(1.0) - F.coalesce(_number(discount), F.lit(0.0)) / 100), 4)


@transform("concat_ws")
def joined(df: DataFrame, cols: list[str], sep: str = " ", cast: str | None = None) -> Column:
    """Columns joined by a separator; nulls are left out."""
    out = F.concat_ws(sep, *[F.col(c).cast("string") for c in cols])
    return out.cast(cast) if cast else out


@transform("compose_id", "shopify_order_line_id")
def compose_id(df: DataFrame, cols: list[str] | None = None) -> Column:
    return F.concat_ws("_", *[F.col(c).cast("string") for c in cols or ["order_id", "sku"]])


@transform("cin7_order_line_id")
def order_line_id(df: DataFrame, cols: list[str] | None = None) -> Column:
    return compose_id(df, cols or ["order_id", "id"])


@transform("first_association", "primary_association")
def first_association(df: DataFrame, path: str, index: int = 1, cast: str = "string") -> Column:
    """The index-th associated value; null where there are fewer. ``a.b.c`` also finds ``a_b_c``."""
    flat = path.replace(".", "_")
    return F.try_element_at(F.col(flat if flat in df.columns else path), F.lit(index)).cast(cast)
