"""Text of a video's frames: grabbed by ffmpeg, recognised region by region.  Imported only where pictures can be read."""

from __future__ import annotations

import os
import shutil
import subprocess
import tempfile

import pytesseract
from PIL import Image, ImageEnhance, ImageFilter, ImageOps

from ..operators.video import FRAME_CANDIDATES, FRAMES, INTERVAL, OCR_FRAMES, SNIPPETS, bands, best_snippets, text_score, times
from .extract import FRAME_LANGUAGES, FRAME_SETTINGS, Extracted


def duration_of(path: str) -> float | None:
    """Seconds, where ffprobe is installed and knows."""
    if not shutil.which("ffprobe"):
        return None
    done = subprocess.run(["ffprobe", "-v", "error", "-show_entries", "format=duration", "-of", "default=noprint_wrappers=1:nokey=1", path], capture_output=True, text=True, check=False)
    try:
        return float(done.stdout) if done.returncode == 0 else None
    except ValueError:
        return None


def grab(path: str, folder: str) -> tuple[list[tuple[int, str]], list[str]]:
    """(number, file) of evenly spaced frames, and warnings for those that ffmpeg can't give."""
    frames, warnings = [], []
    for n, at in enumerate(times(duration_of(path)), 1):
        target = os.path.join(folder, f"{n}.png")
        done = subprocess.run(["ffmpeg", "-hide_banner", "-loglevel", "error", "-ss", f"{at:.3f}", "-i", path, "-frames:v", "1", "-vf", "scale=2600:-2:force_original_aspect_ratio=decrease", target], capture_output=True, text=True, check=False)
        if done.returncode == 0 and os.path.exists(target):
            frames.append((n, target))
        else:
            warnings.append(f"frame {n}: {done.stderr.strip() or done.stdout.strip() or f'ffmpeg exited with {done.returncode}'}")
    return frames, warnings


def worth(picture) -> float:
    """Edges, contrast and middle brightness of the middle of a frame, as a thumbnail 260 pixels wide."""
    gray = ImageOps.grayscale(picture.convert("RGB"))
    middle = gray.crop((0, int(gray.height * 0.18), gray.width, int(gray.height * 0.88)))
    small = middle.resize((260, max(1, int(middle.height * 260 / max(middle.width, 1)))))
    try:
        import cv2
        import numpy as np

        x = np.array(small)
        return 4.0 * np.count_nonzero(cv2.Canny(x, 45, 140)) / max(x.size, 1) + float(x.std()) / 255.0 + ((x > 105) & (x < 245)).sum() / max(x.size, 1)
    except ImportError:
        return sum(small.filter(ImageFilter.FIND_EDGES).histogram()[41:]) / max(small.width * small.height, 1)


def document_box(picture) -> tuple[int, int, int, int] | None:
    """The largest pale rectangle of a document's shape, with a margin; None without the library that finds outlines."""
    try:
        import cv2
        import numpy as np
    except ImportError:
        return None
    hsv = cv2.cvtColor(np.array(picture), cv2.COLOR_RGB2HSV)
    height, width = hsv.shape[:2]
    side = max(15, min(width, height) // 35)
    kernel, best = cv2.getStructuringElement(cv2.MORPH_RECT, (side, side)), (0.0, None)
    for least_value, most_saturation in ((110, 90), (135, 150)):
        mask = ((hsv[:, :, 2] > least_value) & (hsv[:, :, 1] < most_saturation)).astype("uint8") * 255
        mask = cv2.morphologyEx(cv2.morphologyEx(mask, cv2.MORPH_CLOSE, kernel, iterations=2), cv2.MORPH_OPEN, kernel, iterations=1)
        for outline in cv2.findContours(mask, cv2.RETR_EXTERNAL, cv2.CHAIN_APPROX_SIMPLE)[0]:
            x, y, w, h = cv2.boundingRect(outline)
            share, edge = w * h / (width * height), int(max(w, h) * 0.08)
            if 0.08 <= share <= 0.65 and h and 0.8 <= w / h <= 4.2 and share > best[0]:
                best = (share, (x - edge, y - edge, x + w + edge, y + h + edge))
    return best[1]


def enhanced(picture):
    """Gray, contrasted and sharpened, at least 1800 pixels wide where 2.5 times the size is enough for that."""
    scale = min(2.5, 1800 / max(picture.width, 1)) if picture.width < 1800 else 1.0
    large = picture.resize((int(picture.width * scale), int(picture.height * scale))) if scale != 1.0 else picture
    return ImageEnhance.Sharpness(ImageEnhance.Contrast(ImageOps.grayscale(large)).enhance(2.0)).enhance(2.0)


def read_frame(picture) -> list[tuple[int, str, str, str]]:
    """(score, language, variant, text) of the best readings of a frame's regions."""
    rgb, found = picture.convert("RGB"), []
    for name, box in bands(rgb.width, rgb.height, document_box(rgb)):
        variant = enhanced(rgb.crop(box))
        for language in FRAME_LANGUAGES:
            for setting in FRAME_SETTINGS:
                try:
                    text = pytesseract.image_to_string(variant, lang=language, config=setting)
                except Exception:  # noqa: BLE001, S112 - the next language
                    continue
                found.append((text_score(text), language, f"{name}/enhanced_gray {setting}", text))
    return sorted(found, key=lambda f: -f[0])[:FRAME_CANDIDATES]


def read_frames(path: str, out: Extracted) -> None:
    """Fill out with the text of the best frames of a video."""
    out.metadata |= {"frame_interval_seconds": str(INTERVAL), "max_frames": str(FRAMES)}
    with tempfile.TemporaryDirectory(prefix="veilscan-frames-") as folder:
        frames, warnings = grab(path, folder)
        out.warnings += warnings
        out.metadata["frames_extracted"] = str(len(frames))
        if not frames:
            out.warnings.append("No video frames extracted")
            return
        chosen = frames
        if len(frames) > OCR_FRAMES:
            scores = []
            for n, file in frames:
                try:
                    with Image.open(file) as picture:
                        scores.append((-worth(picture), n, file))
                except Exception:  # noqa: BLE001 - a frame that can't be scored comes last
                    scores.append((0.0, n, file))
            chosen = sorted((n, file) for _, n, file in sorted(scores)[:OCR_FRAMES])
        found = []
        for n, file in chosen:
            with Image.open(file) as picture:
                found += [(score, n, language, variant, text.strip()) for score, language, variant, text in read_frame(picture) if score > 0 and text.strip()]
    out.metadata |= {"ocr_used": "true", "frames_ocr_attempted": str(len(chosen)), "ocr_languages": ",".join(sorted({f[2] for f in found})), "ocr_candidate_count": str(len(found))}
    out.text = "\n\n".join(best_snippets(found, SNIPPETS))
