"""Constants of the format, written out apart from the engine's own list."""

from tesselorn.functions import fixed

# The variation names of the flame format.
NAMES = """
linear sinusoidal spherical swirl horseshoe polar handkerchief heart disc spiral hyperbolic diamond ex julia bent waves fisheye popcorn
exponential power cosine rings fan blob pdj fan2 rings2 eyefish bubble cylinder perspective noise julian juliascope blur gaussian_blur
radial_blur pie ngon curl rectangles arch tangent square rays blade secant2 twintrian cross disc2 super_shape flower conic parabola bent2
bipolar boarders butterfly cell cpow curve edisc elliptic escher foci lazysusan loonie pre_blur modulus oscilloscope polar2 popcorn2 scry
separation split splits stripes wedge wedge_julia wedge_sph whorl waves2 exp log sin cos tan sec csc cot sinh cosh tanh sech csch coth
auger flux mobius hemisphere post_curl
""".split()


def test_variation_names():
    assert len(fixed.VARIATIONS) == len(set(fixed.VARIATIONS)) == 101
    assert set(fixed.VARIATIONS) == set(NAMES)
    assert sorted(fixed.HYPER_TRIG) == ["cot", "coth", "csc", "csch", "sec", "sech", "tan", "tanh"]
    assert not set(fixed.NOT_VARIATIONS) & set(fixed.VARIATIONS)


def test_other_constants():
    assert (fixed.BUCKET, fixed.WINDOW, fixed.SCHEMA_VERSION, fixed.GENS_SCHEMA, fixed.BODY_VERSION) == (10_000, 256, 6, 2, 1)
    assert fixed.LIVE_GENS == [247, 248] and fixed.IDENTITY_POST == "1 0 0 1 0 0"
    assert fixed.MANIFEST == ["id", "sha256", "file_size_bytes", "fetched_at", "source_url", "name", "nick", "url", "xform_count", "final_xform", "variations"]
