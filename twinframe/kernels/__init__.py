"""Pixel kernels in numpy: no Spark in here. Images are uint8 arrays, gray (h, w) or blue-green-red (h, w, 3)."""
