"""Raster helpers used inside tasks; arrays are height x width x channels, in the channel order they came in."""

from __future__ import annotations

import struct
import zlib

import numpy as np

LANCZOS_SUPPORT = 3


def to_array(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """Raw image bytes as three channels: grey is widened, an alpha channel dropped."""
    pixels = np.frombuffer(data, dtype=np.uint8).reshape(height, width, channels)
    return np.repeat(pixels, 3, axis=2) if channels == 1 else pixels[:, :, :3]


def stack(images: list[bytes], height: int, width: int, channels: int) -> np.ndarray:
    """Raw images of one size as one array whose third axis holds every image's channels, without an alpha channel."""
    pixels = np.frombuffer(b"".join(images), np.uint8).reshape(len(images), height, width, channels)
    return pixels[..., :3].transpose(1, 2, 0, 3).reshape(height, width, -1)


def unstack(pixels: np.ndarray, images: int) -> np.ndarray:
    """The images of a stack, each height x width x 3; grey is widened."""
    height, width, channels = pixels.shape
    apart = pixels.reshape(height, width, images, channels // images).transpose(2, 0, 1, 3)
    return np.repeat(apart, 3, axis=3) if channels == images else np.ascontiguousarray(apart)


def lanczos_taps(size_in: int, size_out: int) -> tuple[np.ndarray, np.ndarray]:
    """For each output position its input positions and weights (both size_out x taps).

    A windowed sinc, widened when shrinking; the weights of a position sum to 1.
    """
    scale = size_in / size_out
    stretch = max(scale, 1.0)
    reach = LANCZOS_SUPPORT * stretch
    centres = (np.arange(size_out) + 0.5) * scale
    first = np.floor(centres - reach).astype(int)
    at = first[:, None] + np.arange(int(np.ceil(2 * reach)) + 2)[None, :]
    offset = (at + 0.5 - centres[:, None]) / stretch
    weights = np.where(
        (np.abs(offset) < LANCZOS_SUPPORT) & (at >= 0) & (at < size_in),
        np.sinc(offset) * np.sinc(offset / LANCZOS_SUPPORT),
        0.0,
    )
    weights /= weights.sum(axis=1, keepdims=True)
    return at.clip(0, size_in - 1), weights.astype(np.float32)


def _resample_rows(pixels: np.ndarray, taps: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    at, weights = taps
    source = pixels.astype(np.float32)
    out = np.zeros((len(at), *pixels.shape[1:]), np.float32)
    for k in range(at.shape[1]):
        out += source[at[:, k]] * weights[:, k, None, None]
    return np.rint(out).clip(0, 255).astype(np.uint8)


def resize(pixels: np.ndarray, width: int, height: int, cache: dict) -> np.ndarray:
    """Stretch to the given size, one axis after the other. `cache` keeps taps by size."""

    def taps(size_in, size_out):
        key = (size_in, size_out)
        if key not in cache:
            if len(cache) > 4096:
                cache.clear()
            cache[key] = lanczos_taps(size_in, size_out)
        return cache[key]

    h, w, _ = pixels.shape
    out = pixels
    if w != width:
        sideways = np.ascontiguousarray(out.transpose(1, 0, 2))
        out = _resample_rows(sideways, taps(w, width)).transpose(1, 0, 2)
    if h != height:
        out = _resample_rows(np.ascontiguousarray(out), taps(h, height))
    return np.ascontiguousarray(out)


def fill_crop(pixels: np.ndarray, width: int, height: int, cache: dict) -> np.ndarray:
    """Scale until the cell is covered, then cut out the centre."""
    h, w, _ = pixels.shape
    if w / h > width / height:
        new_w, new_h = int(w * height / h), height
    else:
        new_w, new_h = width, int(h * width / w)
    scaled = resize(pixels, new_w, new_h, cache)
    left, top = (new_w - width) // 2, (new_h - height) // 2
    return np.ascontiguousarray(scaled[top : top + height, left : left + width])


def png_bytes(rgb: np.ndarray, level: int = 6) -> bytes:
    """A PNG file of an RGB array."""
    height, width, _ = rgb.shape
    lines = np.concatenate([np.zeros((height, 1), np.uint8), rgb.reshape(height, width * 3)], axis=1)

    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    header = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    return (
        b"\x89PNG\r\n\x1a\n"
        + chunk(b"IHDR", header)
        + chunk(b"IDAT", zlib.compress(lines.tobytes(), level))
        + chunk(b"IEND", b"")
    )
