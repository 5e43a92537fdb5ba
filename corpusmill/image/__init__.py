"""Image bytes: headers, pixels, quality measures and perceptual hashes."""
