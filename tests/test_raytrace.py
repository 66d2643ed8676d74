import numpy as np

from quakespark.operators import raytrace as rt


def test_one_layer_is_a_straight_line():
    delta, depth = np.array([0.0, 3.0, 40.0]), np.array([5.0, 4.0, 10.0])
    top, v = np.array([0.0]), np.array([5.0])
    time, angle = rt.first_arrivals(delta, depth, np.zeros(3), top, v)
    assert np.allclose(time, np.hypot(delta, depth) / 5.0)
    assert np.allclose(angle, 180 - np.degrees(np.arctan2(delta, depth)), atol=1e-3)


def test_direct_ray_beats_every_bent_path():
    """Fermat: the direct time is the smallest over the point where the boundary is crossed."""
    top, v = np.array([0.0, 4.0]), np.array([3.0, 6.0])
    delta, depth = np.array([10.0]), np.array([9.0])
    time, _ = rt.direct_rays(delta, depth - 4.0, np.array([[4.0]]), 1, v)
    x = np.linspace(0, 10, 200_001)
    best = (np.hypot(x, 4.0) / 3.0 + np.hypot(10 - x, 5.0) / 6.0).min()
    assert abs(time[0] - best) < 1e-8


def test_head_wave_of_two_layers():
    v = np.array([4.0, 8.0])
    delta, depth = np.array([60.0, 5.0]), np.array([2.0, 2.0])
    time, sine = rt.head_waves(delta, depth, np.array([[10.0], [10.0]]), 0, v)
    cosine = np.sqrt(1 - 0.25)
    assert abs(time[0] - (60.0 / 8.0 + (2 * 10.0 - 2.0) * cosine / 4.0)) < 1e-12
    assert sine[0] == 0.5 and np.isinf(time[1])          # nearer than the critical distance


def test_slow_layer_carries_no_head_wave():
    v = np.array([4.0, 3.0, 3.5])
    time, _ = rt.head_waves(np.array([100.0]), np.array([1.0]), np.array([[2.0, 2.0]]), 0, v)
    assert np.isinf(time[0])


def test_layered_and_straight_agree_for_one_speed(spark):
    stations = spark.createDataFrame([("A", 40.1, -124.2, 0.3), ("B", 40.4, -124.6, 0.0)], "sta string, lat double, lon double, elev_km double")
    sources = spark.createDataFrame([(1, 40.25, -124.5, 7.0), (2, 40.3, -124.4, 11.0)], "id long, lat double, lon double, depth_km double")
    paths = spark.createDataFrame([("A", 1), ("A", 2), ("B", 1), ("B", 2)], "sta string, id long")
    geometry = rt.path_geometry(paths, sources, stations)
    model = rt.velocity_model([0.0], [6.0], [1.73])
    layered = {(r.sta, r.id): r for r in rt.travel_times(geometry, model).collect()}
    straight = {(r.sta, r.id): r for r in rt.travel_times(geometry, model, "straight").collect()}
    for key, row in straight.items():
        assert np.allclose([layered[key][c] for c in rt.TT_COLUMNS], [row[c] for c in rt.TT_COLUMNS], atol=1e-5)


def test_partials_are_derivatives(spark):
    """Moving the source changes the time as the derivatives say (x east, y north, z down)."""
    station = spark.createDataFrame([("A", 40.0, -124.0, 0.0)], "sta string, lat double, lon double, elev_km double")
    step = 0.0005
    places = [(0, 40.2, -124.3, 8.0), (1, 40.2 + step, -124.3, 8.0), (2, 40.2, -124.3, 8.0 + 0.05)]
    sources = spark.createDataFrame(places, "id long, lat double, lon double, depth_km double")
    paths = spark.createDataFrame([("A", i) for i in range(3)], "sta string, id long")
    model = rt.velocity_model([0.0, 3.0, 12.0], [4.0, 5.5, 7.0], [1.73] * 3)
    t = {r.id: r for r in rt.travel_times(rt.path_geometry(paths, sources, station), model).collect()}
    # derivatives point along the ray away from the station, time falls when the source moves along them
    assert abs((t[1].tt_p - t[0].tt_p) / (step * 111.1) + t[0].py) < 0.01
    assert abs((t[2].tt_p - t[0].tt_p) / 0.05 + t[0].pz) < 0.01
