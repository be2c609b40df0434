"""Small images as pixel relations."""

import numpy as np
import pandas as pd


def encode_grid(spark, img: int, rgb: np.ndarray):
    h, w = rgb.shape[:2]
    y, x = np.divmod(np.arange(h * w), w)
    flat = rgb.reshape(-1, 3).astype(int)
    return spark.createDataFrame(pd.DataFrame({"img": img, "y": y, "x": x, "r": flat[:, 0], "g": flat[:, 1], "b": flat[:, 2]}), "img long, y int, x int, r int, g int, b int")
