"""Product split and sale ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caderneta.functions.dates import date_text
from caderneta.functions.text import product_code, product_description


def standardize(items: DataFrame) -> DataFrame:
    """Adds product code and description, ``id_venda`` and ``id_item_venda``."""
    product = F.col("produto")
    sale_id = F.concat("tipo_documento", "numero_documento", date_text(F.col("data_emissao")))
    return items.withColumns(
        {
            "codigo_produto": product_code(product),
            "descricao_produto": product_description(product),
            "id_venda": sale_id,
            "id_item_venda": F.concat(sale_id, "protocolo"),
        }
    )
