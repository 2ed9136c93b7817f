"""The data format's rules once more in plain Python, to compare against."""

import hashlib
import json


def digest(value, algo="sha256"):
    text = json.dumps(value, sort_keys=True, separators=(",", ":"))
    return getattr(hashlib, algo)(text.encode()).hexdigest()


def creator_hash(name, urls, metadata=None, algo="sha256"):
    clean = sorted(u.strip() for u in urls if u.strip())
    return digest(
        {
            "creator_name": name.strip().lower(),
            "image_urls": clean,
            "metadata": metadata or {},
            "url_count": len(clean),
        },
        algo,
    )


def set_hash(urls, algo="sha256"):
    clean = sorted({u.strip() for u in urls if u.strip()})
    return digest({"urls": clean, "count": len(clean)}, algo)


def name_number(name, algo="sha256"):
    return int.from_bytes(hashlib.new(algo, name.strip().lower().encode()).digest()[:4], "big")


def safe(name):
    kept = "".join(c for c in name if c.isalnum() or c in " -_").strip()
    return kept.replace(" ", "_")


def greedy(sizes, target):
    """Balanced packing, one creator after the other; returns creator -> batch."""
    batches, chosen = [], {}
    for name, n in sorted(sizes, key=lambda s: -s[1]):
        if not batches:
            batches.append(n)
            chosen[name] = 0
            continue
        wanted = name_number(name) % (len(batches) + 1)
        if wanted == len(batches):
            batches.append(0)
        if batches[wanted] + n > 1.5 * target:
            fitting = [(abs(target - b - n), i) for i, b in enumerate(batches) if b + n <= 2 * target]
            if fitting:
                wanted = min(fitting)[1]
            else:
                batches.append(0)
                wanted = len(batches) - 1
        batches[wanted] += n
        chosen[name] = wanted
    order = {b: i for i, b in enumerate(sorted(set(chosen.values())))}
    return {name: order[b] for name, b in chosen.items()}


def next_fit(sizes, target):
    batch, filled, chosen = 0, 0, {}
    for name, n in sorted(sizes, key=lambda s: -s[1]):
        if filled and filled + n > target:
            batch, filled = batch + 1, 0
        filled += n
        chosen[name] = batch
    return chosen
